"""Session construction, shared scratch folder, shipping of the package, lineage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}
_STAGES: list[tuple[SparkSession, str]] = []


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with the settings the oracle comparison relies on.

    On a cluster the builder picks up the cluster's own master and settings;
    only unset keys are filled here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.driver.memory", "8g")
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ready(spark)
    return spark


def ready(spark: SparkSession) -> None:
    """What every query needs: a shared folder, and this package on the workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Functions that run in Python workers are pickled by reference; the workers
    of a cluster, or of a driver started in another folder, do not have the
    package otherwise. The archive goes through Spark's own file distribution.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    tmp = tempfile.TemporaryDirectory()  # the driver's own; executors fetch it from the driver while the session lasts
    path = os.path.join(tmp.name, f"tessera-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, here)))
    sc.addPyFile(path)
    _SHIPPED[sc.applicationId] = tmp


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a folder that all executors share. Only a local master,
    where driver and executors are one process, gets one of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that serves this session only: it is removed when the process ends."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _STAGES.append((spark, path))
    return path


@atexit.register
def drop_stages() -> None:
    """Remove the stage tables of this process; they serve one session only."""
    while _STAGES:
        spark, path = _STAGES.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session has ended; its folder is the cluster's to clean
            pass


def materialize(df: DataFrame, mode: str = "checkpoint") -> DataFrame:
    """Cut lineage before a frame is scanned by several global aggregates.

    ``checkpoint`` writes the frame as a Parquet table under the shared
    ``spark.checkpoint.dir`` and reads it back: it survives executor loss, and
    being columnar, later aggregates read only the columns they use (an RDD
    checkpoint would serialise whole rows). ``cache`` keeps blocks in
    executors (recomputed from lineage if lost); ``none`` keeps the plan lazy.
    """
    if mode == "checkpoint":
        spark = df.sparkSession
        path = stage_path(spark, "stage")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    if mode == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


#: Spark's own setting: the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize_each(frames: Sequence[DataFrame], mode: str = "checkpoint") -> DataFrame:
    """``materialize`` of the union of ``frames``, written one after the other: the disk holds the shuffle files of one."""
    if mode != "checkpoint":
        return materialize(reduce(DataFrame.unionByName, frames), mode)
    spark = frames[0].sparkSession
    path = stage_path(spark, "stage")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        for df in frames:
            df.write.mode("append").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)
