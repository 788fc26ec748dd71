"""Helpers shared by the corpus operators: scans, written stages, skew-safe grouping, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, stage_path

#: Sub-groups into which the rows of one key are dealt (at most 62: they are bits of a long).
SALTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``sf_dir`` (any path that Spark reads)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that ``spark.checkpoint.dir`` names."""
    return os.path.join(ensure_checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet (in folders by the columns ``by``) in the shared folder and read it back.

    The table serves this session and is removed when its process ends.
    Cuts lineage: what follows is recomputed from the table, so a lost executor
    costs only its own tasks. Unlike an RDD checkpoint it keeps columns pruned.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted(df: DataFrame, by: str | Column, salts: int = SALTS) -> DataFrame:
    """Add ``_salt`` in [0, salts), from a hash of ``by``."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))


def salt_mask() -> Column:
    """The set of a group's salts, as bits of a long (a plain hash aggregate)."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_salt")))


def per_salt(groups: DataFrame, mask: str = "_mask", salts: int = SALTS) -> DataFrame:
    """One row for each group and salt that occurs in it."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)),
                    lambda i: F.call_function("shiftright", F.col(mask), i).bitwiseAND(F.lit(1)) == 1)
    return groups.withColumn("_salt", F.explode(bits)).drop(mask)


def with_group(rows: DataFrame, keys: Sequence[str], spread_by: str | Column,
               first: Mapping[str, Column], second: Mapping[str, Column],
               keep: Callable[[DataFrame], DataFrame] = lambda g: g, salts: int = SALTS) -> DataFrame:
    """Join each row with aggregates of its group, however large the group is.

    ``first`` aggregates rows by (keys, salt), ``second`` aggregates those
    results by keys; ``keep`` may filter or extend the groups. The way back
    joins on (keys, salt), so the rows of a hot key meet in ``salts`` places.
    Rows of groups that ``keep`` removes, or with a null key, are dropped.
    """
    rows = salted(rows, spread_by, salts)
    part = rows.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in first.items()])
    whole = part.groupBy(*keys).agg(*[c.alias(n) for n, c in second.items()], salt_mask().alias("_mask"))
    return rows.join(per_salt(keep(whole), salts=salts), [*keys, "_salt"]).drop("_salt")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (long ids): (node, component).

    ``component`` is the smallest id reachable. Large-star and small-star steps
    alternate until nothing changes; every round is written to the shared
    folder and only a checksum of it reaches the driver. A star's centre finds
    its least neighbour by an aggregate with map-side combine and meets its
    edges again by (node, salt), so a node with very many neighbours is never
    gathered in one task. Nulls and loops are ignored.
    """
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")) \
        .where("u <> v").distinct()
    cur = written(pairs, "cc")
    seen = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every neighbour larger than u goes to the least of u's neighbourhood
        large = with_group(both, ["u"], "v", {"m": F.min("v")}, {"m": F.min("m")}).where("v > u") \
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        # small star: u and all its smaller neighbours go to the least of them
        small = with_group(large, ["u"], "v", {"m": F.min("v")}, {"m": F.min("m")})
        nxt = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        cur = written(nxt, "cc")
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    nodes = cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
