"""Running totals that do not put a whole group in one task.

``Window.partitionBy(key).orderBy(o)`` sends every row of a key to one task; a
key holding a third of all rows (or an un-partitioned window over a large
frame) then runs on one core. ``running_sum`` computes the same inclusive
prefix sum in bounded steps:

1. range-partition by (key, order) and write the slices: a hot key is spread
   over many partitions in order ranges. The written table fixes which row is
   in which slice; slices and totals planned from the range exchange itself
   would each sample boundaries of their own;
2. a local running sum inside each (slice, key) and one total per slice;
3. the offset of a slice = sum of the totals of the same key in earlier
   slices. Ranges are contiguous, so at most one key of a slice goes on from
   the slice before: there are fewer offsets than slices, and they are
   broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def running_sum(df: DataFrame, value: str, order_by: Sequence[Column], out: str,
                partition_by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value`` over ``order_by``
    within ``partition_by`` (nulls of a key are one group, null values add
    nothing). ``order_by`` must be a total order for deterministic results."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_by)
    ranged = materialize(df.repartitionByRange(n, *[F.col(k) for k in keys], *order_by)
                           .withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid", *keys).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    totals = ranged.groupBy("_pid", *keys).agg(F.sum(value).alias("_tot"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.sum("_tot").over(before)).where("_off IS NOT NULL") \
        .select(F.col("_pid").alias("_off_pid"), *[F.col(k).alias(f"_off_{i}") for i, k in enumerate(keys)], "_off")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_off_{i}")) for i, k in enumerate(keys)],
                  F.col("_pid") == F.col("_off_pid"))
    own = F.col("_local")
    total = F.when(F.col("_off").isNull(), own).otherwise(F.col("_off") + F.coalesce(own, F.lit(0)))
    return (ranged.withColumn("_local", F.sum(value).over(local))
                  .join(F.broadcast(offsets), same, "left")
                  .withColumn(out, total)
                  .select(*df.columns, out))
