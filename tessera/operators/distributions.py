"""The numbers behind the distribution charts.

Everything is an aggregate: per-column statistics (bounded) are attached to
rows as scalar subqueries or small joins, and per-row work has a fixed fan-out
(grid points, not pairs of rows).
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import round_half_even
from tessera.functions.quantiles import long_values, percentiles
from tessera.session import materialize

# The reference's chart bin counts (age density histogram, discount
# in percent, order value) and KDE grid size.
HIST_BINS = {"age": 25, "discount": 15, "total_sales": 50}
HIST_SCALE = {"discount": 100.0}
KDE_GRID = 300


def rating_buckets(df: DataFrame, col: str = "customer_rating") -> DataFrame:
    """Counts of round-half-even(rating) = 1..5, empty buckets included."""
    r = F.rint(F.col(col))
    one = df.agg(*[F.count_if(r == k).alias(str(k)) for k in range(1, 6)])
    return one.unpivot([], [str(k) for k in range(1, 6)], "rating", "orders").select(
        F.col("rating").cast("int").alias("rating"), F.col("orders").cast("long").alias("orders"))


def histogram(df: DataFrame, bins: Mapping[str, int] = HIST_BINS,
              scale: Mapping[str, float] = HIST_SCALE) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), with the
    count and the density count / (N * width), empty bins included."""
    cols = [c for c in bins if c in df.columns]
    scaled = df.select(*[(F.col(c) * scale.get(c, 1.0)).cast("double").alias(c) for c in cols])
    lng = long_values(scaled, cols)
    st = lng.groupBy("column").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"))
    # one row per column: literals in the plan of the rows, so nothing is joined to them. A constant
    # column gets a range of one around its value
    rows = [(r["column"], *((r.lo, r.hi) if r.lo < r.hi else (r.lo - 0.5, r.hi + 0.5)), r.n, bins[r["column"]])
            for r in st.collect()]
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, bin_lo double, bin_hi double, count long, density double")
    st = df.sparkSession.createDataFrame(rows, "column string, lo double, hi double, n long, nbins int")
    of = lambda i: F.create_map(*[x for r in rows for x in (F.lit(r[0]), F.lit(r[i]))])[F.col("column")]
    idx = F.least(F.floor((F.col("v") - of(1)) * (of(4) / (of(2) - of(1)))).cast("int"), of(4) - 1)
    counts = lng.groupBy("column", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("hi") - F.col("lo")) / F.col("nbins")
    spine = st.select("column", "lo", "hi", "n", "nbins",
                      F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
    out = spine.join(counts, ["column", "bin"], "left").fillna(0, subset=["count"])
    return out.select(
        "column", "bin",
        round_half_even(F.col("lo") + F.col("bin") * width, 6).alias("bin_lo"),
        round_half_even(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("bin_hi"),
        F.col("count").cast("long").alias("count"),
        round_half_even(F.col("count") / (F.col("n") * width), 10).alias("density"))


def kde(df: DataFrame, col: str = "age", grid: int = KDE_GRID) -> DataFrame:
    """Gaussian KDE (Scott bandwidth h = std * n^(-1/5)) on a grid of
    ``grid`` points from min to max, plus mean / median markers.

    Distinct values are counted first (partial aggregation), then each distinct
    value contributes to every grid point: a fixed fan-out of ``grid`` rows.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    s = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"),
              F.stddev_samp("x").alias("sd"), F.avg("x").alias("mean")).first()
    lo, hi, n, mean = (F.lit(s[c]).cast("double") for c in ("lo", "hi", "n", "mean"))
    h = F.lit(s["sd"]).cast("double") * F.pow(n, F.lit(-0.2))
    vc = x.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    g = vc.select("x", "c", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    gv = lo + F.col("i") * ((hi - lo) / (grid - 1))
    z = F.try_divide(gv - F.col("x"), h)  # no spread: the density is null
    dens = (g.groupBy("i").agg(F.first(gv).alias("x"), F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("k"))
             .select("i", "x", F.try_divide(F.col("k"), n * h * math.sqrt(2 * math.pi)).alias("density")))
    med = percentiles(df, [col], [0.5]).select("value").scalar()
    return dens.select(F.col("i").alias("point"), round_half_even(F.col("x"), 6).alias("x"),
                       round_half_even(F.col("density"), 10).alias("density"),
                       round_half_even(mean, 4).alias("mean"), round_half_even(med, 4).alias("median"))


def _quartiles(df: DataFrame, value: str, group: str) -> DataFrame:
    q = percentiles(df.where(F.col(group).isNotNull()), [value], [0.25, 0.5, 0.75], by=[group])
    return q.groupBy(group).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                  for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])


def violin(df: DataFrame, value: str = "unit_price", group: str = "product_category") -> DataFrame:
    """Per-group quartiles, groups ordered by median (descending)."""
    q = _quartiles(df, value, group)
    w = Window.orderBy(F.desc("median"), group)  # over the bounded group table
    return q.select(group, F.row_number().over(w).alias("position"),
                    *[round_half_even(F.col(c), 4).alias(c) for c in ("q1", "median", "q3")])


def box(df: DataFrame, value: str = "customer_rating", group: str = "product_category",
        whisker: float = 1.5) -> DataFrame:
    """Box-plot summary per group: quartiles, whiskers (extreme values
    inside the 1.5-IQR fences), number of fliers; ordered by mean value."""
    q = _quartiles(df, value, group)
    iqr = F.col("q3") - F.col("q1")
    # written: the planner knows the size of the group table, rows are not shuffled onto a few keys
    fences = materialize(q.select(group, "q1", "median", "q3", (F.col("q1") - whisker * iqr).alias("lo_f"),
                      (F.col("q3") + whisker * iqr).alias("hi_f")))
    v = F.col(value)
    inside = (v >= F.col("lo_f")) & (v <= F.col("hi_f"))
    agg = (df.where(F.col(group).isNotNull() & v.isNotNull()).join(fences, group)
             .groupBy(group, "q1", "median", "q3")
             .agg(F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
                  F.count_if(~inside).alias("fliers"), F.avg(v).alias("mean")))
    w = Window.orderBy(F.desc("mean"), group)
    return agg.select(group, F.row_number().over(w).alias("position"),
                      *[round_half_even(F.col(c), 4).alias(c) for c in
                        ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                      "fliers", round_half_even(F.col("mean"), 4).alias("mean"))


# Violin density defaults (grid points, support extended by
# ``cut`` bandwidths beyond the data on each side).
VIOLIN_GRID = 100
VIOLIN_CUT = 2.0


def kde_by(df: DataFrame, value: str = "unit_price", group: str = "product_category",
           grid: int = VIOLIN_GRID, cut: float = VIOLIN_CUT) -> DataFrame:
    """A33 density: Gaussian KDE of ``value`` per group (Scott bandwidth
    h = std * n^(-1/5)), on ``grid`` points from min - cut*h to max + cut*h.

    Per group one aggregate with a sum for each grid point: rows are neither
    exploded nor shuffled, only ``grid`` partial sums per group and task are. The
    statistics of the groups are written first, so the planner knows their size.
    A group without spread (one row, one value) has its value at every point and
    a null density.
    """
    x = (df.where(F.col(group).isNotNull())
           .select(group, F.col(value).cast("double").alias("x"))
           .where(F.col("x").isNotNull() & ~F.isnan("x")))
    h = F.coalesce(F.col("sd"), F.lit(0.0)) * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    st = (x.groupBy(group).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"),
                               F.stddev_samp("x").alias("sd"))
           .withColumn("h", h)
           .select(group, "n", "h", (F.col("lo") - cut * F.col("h")).alias("g0"),
                   ((F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)).alias("step")))
    st = materialize(st)

    def z(i):
        return F.try_divide(F.col("g0") + F.lit(i) * F.col("step") - F.col("x"), F.col("h"))
    sums = x.join(st, group).groupBy(group, "n", "h", "g0", "step").agg(
        *[F.sum(F.exp(-0.5 * z(i) * z(i))).alias(f"k{i}") for i in range(grid)])
    out = sums.select(group, "n", "h", "g0", "step", F.posexplode(F.array(*[f"k{i}" for i in range(grid)])).alias("point", "k"))
    dens = F.try_divide(F.col("k"), F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    return out.select(group, F.col("point").cast("int").alias("point"),
                      round_half_even(F.col("g0") + F.col("point") * F.col("step"), 6).alias("x"),
                      round_half_even(dens, 12).alias("density"))
