"""File sources and sinks.

CSV is read with an explicit schema (no inference pass) in PERMISSIVE mode;
Parquet is the format between stages. Malformed rows can be kept apart with a
reason for each field (``read_quarantined``). Report tables are written as a
set that appears whole or not at all (``write_reports``, ``read_reports``).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

# The raw 20-column sales layout (types on read; order_date stays text until parsed).
RAW_SCHEMA = StructType([
    StructField("order_id", StringType()), StructField("customer_id", StringType()),
    StructField("customer_name", StringType()), StructField("age", DoubleType()),
    StructField("gender", StringType()), StructField("city", StringType()),
    StructField("state", StringType()), StructField("region", StringType()),
    StructField("loyalty_tier", StringType()), StructField("product_category", StringType()),
    StructField("product_name", StringType()), StructField("quantity", IntegerType()),
    StructField("unit_price", DoubleType()), StructField("discount", DoubleType()),
    StructField("total_sales", DoubleType()), StructField("order_date", StringType()),
    StructField("payment_method", StringType()), StructField("customer_rating", DoubleType()),
    StructField("return_flag", BooleanType()), StructField("shipping_days", DoubleType()),
])


def read_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
             corrupt_col: str | None = None) -> DataFrame:
    """Header CSV with a declared schema; malformed fields become null
    (optionally the raw line is kept in ``corrupt_col``)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt_col:
        schema = StructType(schema.fields + [StructField(corrupt_col, StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    return r.schema(schema).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                mode: str = "overwrite") -> str:
    """S3: write a frame (the cleaned table) as Parquet or CSV."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        # keep padding: the raw text is the data the cleaning steps inspect
        (w.option("header", True).option("ignoreLeadingWhiteSpace", False)
          .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        w.format(fmt).save(path)
    return path


# ------------------------------------------------------------------ S1: malformed rows
def read_quarantined(spark: SparkSession, path: str, schema: StructType, header: bool = True,
                     date_format: str = "yyyy-MM-dd") -> tuple[DataFrame, DataFrame]:
    """S1 with malformed rows kept apart: (good rows with ``schema``, rejected rows with line and reasons).

    The file is read once, every field as text beside the raw line; fields are
    cast with ``try_cast`` and both parts are written by one job, in folders of
    their own. ``reasons`` has a (field, reason) for each fault of a row: ``type``
    for text that is no value of the field's type, ``missing`` for a null in a
    field that is not nullable, and (field null) ``columns`` for a row with more
    or fewer fields than the schema. A row is good if it has none. Empty text
    is null. A line that is no CSV record at all counts as ``columns``.
    """
    from tessera.session import stage_path

    line = "_line"
    text = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(line, StringType())])
    raw = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
           .option("columnPruning", False).schema(text).csv(path))
    values, faults = [], [F.when(F.col(line).isNotNull(), F.struct(F.lit(None).cast("string").alias("field"), F.lit("columns").alias("reason")))]
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.simpleString()
        v = c if kind == "string" else F.to_date(F.try_to_timestamp(c, F.lit(date_format))) if kind == "date" else F.trim(c).try_cast(f.dataType)
        values.append(v.alias(f.name))
        bad = F.when(c.isNotNull() & v.isNull(), "type")
        if not f.nullable:
            bad = bad.when(c.isNull(), "missing")
        # fields of a row of another width are not where they belong: only the width is told
        faults.append(F.when(bad.isNotNull() & F.col(line).isNull(), F.struct(F.lit(f.name).alias("field"), bad.alias("reason"))))
    reasons = F.filter(F.array(*faults), lambda x: x.isNotNull())
    shown = F.coalesce(F.col(line), F.concat_ws(",", *[F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in schema.fields]))
    out = raw.select(F.struct(*values).alias("row"), shown.alias("line"), reasons.alias("reasons"))
    split = out.withColumn("good", F.size("reasons") == 0)
    split = split.select(F.when(F.col("good"), F.col("row")).alias("row"), F.when(~F.col("good"), F.col("line")).alias("line"), "reasons", "good")
    base = stage_path(spark, "csv")
    split.write.partitionBy("good").parquet(base)
    back = spark.read.schema(split.schema).parquet(base)
    return (back.where("good").select("row.*"), back.where("NOT good").select("line", "reasons"))


# ------------------------------------------------------------------ S5-S7: report sets
POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    """The file context of a path (any Hadoop file system) and a maker of its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    return hadoop.FileContext.getFileContext(hadoop.Path(path).toUri(), conf) if "://" in path else hadoop.FileContext.getFileContext(conf), hadoop


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it into place: it is there whole or not at all."""
    context, hadoop = _fs(spark, path)
    part = hadoop.Path(f"{path}.{uuid.uuid4().hex}.part")
    fs = part.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    over = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = over
    context.rename(fs.makeQualified(part), fs.makeQualified(hadoop.Path(path)), options)


def _get(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    stream = fs.open(hadoop)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def _digest(df: DataFrame):
    """Count and order-free digest of rows: the sum of a 64-bit hash of all columns."""
    rows = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0)
    return {"rows": F.count(F.lit(1)), "digest": F.coalesce(F.sum(rows.cast("decimal(38,0)")).cast("string"), F.lit("0"))}


def write_reports(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Persist the named result tables as one set under ``base``.

    Each table goes to a folder of a new run; the writing job counts and digests
    its rows on the way. Then the run's manifest is written, and one rename
    turns the pointer ``CURRENT`` to it. Until then readers see the set before:
    a run that fails on any table changes nothing for them.
    """
    run = uuid.uuid4().hex
    out, manifest = {}, {}
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        seen = Observation()
        path = os.path.join(base, "runs", run, name)
        out[name] = write_table(df.observe(seen, *[c.alias(n) for n, c in _digest(df).items()]), path, fmt, mode="errorifexists")
        manifest[name] = {"path": f"runs/{run}/{name}", "schema": df.schema.jsonValue(), "format": fmt, **seen.get}
    if spark is not None:
        at = os.path.join(base, "runs", run, "MANIFEST.json")
        _put(spark, at, json.dumps(manifest))
        _put(spark, os.path.join(base, POINTER), f"runs/{run}/MANIFEST.json")
    return out


def read_manifest(spark: SparkSession, base: str) -> dict[str, dict]:
    """The manifest of the published set; empty if none was ever published."""
    at = _get(spark, os.path.join(base, POINTER))
    return json.loads(_get(spark, os.path.join(base, at))) if at else {}


def read_reports(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the published set, by the manifest."""
    return {n: spark.read.format(m["format"]).schema(StructType.fromJson(m["schema"])).load(os.path.join(base, m["path"]))
            for n, m in read_manifest(spark, base).items()}


def check_reports(spark: SparkSession, base: str) -> DataFrame:
    """(table, rows, intact): what is there of each published table, and whether count and digest are the manifest's."""
    manifest, parts = read_manifest(spark, base), []
    for name, df in sorted(read_reports(spark, base).items()):
        m = manifest[name]
        found = df.agg(*[c.alias(n) for n, c in _digest(df).items()])
        same = (F.col("rows") == m["rows"]) & (F.col("digest") == m["digest"])
        parts.append(found.select(F.lit(name).alias("table"), "rows", same.alias("intact")))
    out = spark.createDataFrame([], "table string, rows long, intact boolean")
    for x in parts:
        out = out.unionByName(x)
    return out


__all__ = ["RAW_SCHEMA", "check_reports", "read_csv", "read_manifest", "read_quarantined", "read_reports", "write_reports", "write_table"]
