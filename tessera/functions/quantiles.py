"""Exact order statistics in two scans, seeded by a mergeable quantile sketch.

Spark's ``percentile``/``median`` aggregates are exact but keep a map of
distinct value -> count per group and merge it in a single task; over a
high-cardinality measure at scale that map is unbounded. ``percentiles`` finds
the same order statistics by distributed selection, at every size alike:

1. one scan builds a KLL sketch, the count and the extremes of every column
   (and group). The sketch's error bound gives each wanted rank a narrow window
   of values;
2. one scan counts the values below each window and groups the values inside by
   value: about ``4 * rank_error`` of the rows, or fewer if values repeat. These
   candidates are written;
3. a rank that falls outside its window (the bound holds with 99 % confidence,
   and twice the bound is used) shows in these counts. Such windows are opened
   on the side of the miss and one further scan is made: it cannot miss;
4. running totals over range slices of the candidates find the values: no
   window of one key is sorted in one task.

So the input is read two times, three at most, whatever its spread. Windows are
one small row for each column (and group); the planner broadcasts them if their
written size allows it, and joins by shuffle otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.windows import running_sum
from tessera.session import ensure_checkpoint_dir, materialize

#: Size of a sketch: at most about 100 KB for a column and group.
SKETCH = 4096


def rank_error(k: int) -> float:
    """Normalised rank error of a KLL sketch of size k, at 99 % confidence (fixed values of the sketch's definition)."""
    return 2.296 / k ** 0.9723


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, v) rows for the non-null, non-NaN values of ``cols``."""
    base = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    lng = base.unpivot(list(by), list(cols), "column", "v") if by else \
        base.unpivot([], list(cols), "column", "v")
    return lng.where(F.col("v").isNotNull() & ~F.isnan("v"))


def percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                by: Sequence[str] = (), interpolation: str = "linear",
                sketch: int = SKETCH, slack: float = 2.0, value_col: str = "value") -> DataFrame:
    """Exact percentiles of each column in ``cols`` (per ``by`` group).

    Returns ``(by..., column, prob, value, lower, higher)``: ``lower`` and
    ``higher`` are the order statistics either side of the position and
    ``value`` the one chosen by ``interpolation``: ``linear``
    (pandas / SQL ``quantile_cont``: ``a + (b - a) * frac``), ``lower`` or
    ``higher`` (``higher`` at 0.5 is the upper median ``sorted[n // 2]``).
    A column (of a group) without any value has no rows; rows with a null group
    are a group. ``sketch`` and ``slack`` (error bounds on either side of a
    rank) set how many candidates there are, never the result.
    """
    if interpolation not in ("linear", "lower", "higher"):
        raise ValueError(f"unknown interpolation {interpolation!r}")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    inf = float("inf")
    value = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    # names of their own: a group column may be called like anything here
    keys = [f"_by{i}" for i in range(len(by))]
    names = {f"_c{i}": c for i, c in enumerate(cols)}
    base = df.select(*[F.col(b).alias(k) for k, b in zip(keys, by)], *[value(c).alias(n) for n, c in names.items()])

    # 1. sketches, one struct for each column
    per = [F.struct(F.lit(i).alias("_col"), F.count(n).alias("n"), F.min(n).alias("lo"), F.max(n).alias("hi"),
                    F.kll_sketch_agg_double(n, sketch).alias("kll")) for i, n in enumerate(names)]
    sketches = base.groupBy(*keys).agg(F.array(*per).alias("s")).select(*keys, F.inline("s")).where("n > 0")
    # a rank's share of n is at most 2/n from prob; where that is not small beside the margin, n is, and all values are in
    margin, small = 1.5 * slack * rank_error(sketch), F.col("n") < 4 / rank_error(sketch)
    at = lambda r: F.kll_sketch_get_quantile_double("kll", F.lit(r))
    prob = F.explode(F.array(*[F.struct(
        F.lit(w).alias("w"), F.lit(float(p)).alias("prob"),
        (F.when(small, F.col("lo")).otherwise(at(p - margin)) if p > margin else F.col("lo")).alias("lo"),
        (F.when(small, F.col("hi")).otherwise(at(p + margin)) if p + margin < 1 else F.col("hi")).alias("hi"))
        for w, p in enumerate(probs)]))
    t = sketches.select(*keys, "_col", "n", prob.alias("p")).select(*keys, "_col", "n", "p.*")
    pos = F.col("prob") * (F.col("n") - 1)
    windows = materialize(t.select(*keys, "_col", "w", "prob", (pos - F.floor(pos)).alias("frac"), F.floor(pos).cast("long").alias("k0"),
                                   F.ceil(pos).cast("long").alias("k1"), "lo", "hi"))

    def candidates(of: DataFrame, columns: list[int]) -> DataFrame:
        """(keys, _col, w, v, c): the values in each window with their counts; v is null for those below it."""
        rows = base.select(*keys, F.explode(F.array(*[
            F.struct(F.lit(i).alias("_col"), F.col(f"_c{i}").alias("v")) for i in columns])).alias("x")) \
            .select(*keys, "x._col", "x.v").where("v IS NOT NULL")
        each = of.groupBy(*keys, "_col").agg(F.collect_list(F.struct("w", "lo", "hi")).alias("ws"))  # len(probs) at most
        r, e = rows.alias("r"), each.alias("e")
        on = reduce(lambda x, y: x & y, [F.col(f"r.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*keys, "_col"]])
        near = F.filter("ws", lambda x: F.col("r.v") <= x.hi)
        hit = r.join(e, on).select(*[F.col(f"r.{k}") for k in [*keys, "_col", "v"]], F.explode(near).alias("x"))
        return materialize(hit.groupBy(*keys, "_col", F.col("x.w").alias("w"), F.when(F.col("v") >= F.col("x.lo"), F.col("v")).alias("v"))
                           .agg(F.count(F.lit(1)).alias("c")))

    def located(found: DataFrame, of: DataFrame) -> DataFrame:
        """``of`` with the number of values below and in each window."""
        n = found.groupBy(*keys, "_col", "w").agg(F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("c"))), F.lit(0)).alias("below"),
                                                  F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("c"))), F.lit(0)).alias("inside"))
        n = n.withColumnsRenamed({k: f"{k}_n" for k in [*keys, "_col", "w"]})
        on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_n")) for k in [*keys, "_col", "w"]])
        return of.join(n, on, "left").drop(*[f"{k}_n" for k in [*keys, "_col", "w"]]).fillna(0, subset=["below", "inside"])

    # 2. candidates, 3. once more for windows that were missed
    found = candidates(windows, list(range(len(cols))))
    known = materialize(located(found, windows))
    low, high = F.col("k0") < F.col("below"), F.col("k1") >= F.col("below") + F.col("inside")
    missed = known.where(low | high)
    again = sorted(r[0] for r in missed.select("_col").distinct().collect())  # numbers of columns
    if again:
        wider = materialize(missed.select(*windows.columns[:-2], F.when(low, -inf).otherwise(F.col("lo")).alias("lo"),
                                          F.when(high, inf).otherwise(F.col("hi")).alias("hi")))
        more = candidates(wider, again)
        gone = wider.select(*[F.col(k).alias(f"{k}_g") for k in [*keys, "_col", "w"]])
        on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}_g")) for k in [*keys, "_col", "w"]])
        found = found.join(gone, on, "left_anti").unionByName(more)
        known = materialize(known.where(~(low | high)).unionByName(located(more, wider)))

    # 4. the values at the two ranks, by running totals within each window
    ranked = running_sum(found.where("v IS NOT NULL"), "c", [F.col("v")], "upto", partition_by=[*keys, "_col", "w"])
    k = known.withColumnsRenamed({x: f"{x}_k" for x in [*keys, "_col", "w"]})
    on = reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(f"{x}_k")) for x in [*keys, "_col", "w"]])
    rank = F.col("below") + F.col("upto")
    got = ranked.join(k, on).groupBy(*keys, "_col", "prob", "frac").agg(
        F.min(F.when(rank > F.col("k0"), F.col("v"))).alias("a"), F.min(F.when(rank > F.col("k1"), F.col("v"))).alias("b"))
    if interpolation == "linear":
        val = F.when((F.col("frac") == 0) | (F.col("a") == F.col("b")), F.col("a")).otherwise(
            F.col("a") + F.col("frac") * (F.col("b") - F.col("a")))
    else:
        val = F.col("b") if interpolation == "higher" else F.col("a")
    column = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_col") + 1)
    return materialize(got.select(*[F.col(x).alias(b) for x, b in zip(keys, by)], column.alias("column"), "prob",
                                  val.alias(value_col), F.col("a").alias("lower"), F.col("b").alias("higher")))
