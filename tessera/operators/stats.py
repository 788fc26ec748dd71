"""Descriptive and inferential statistics.

All moments are algebraic aggregates (partial per task, merged once), so they
run in one pass with bounded state whatever the skew. Test statistics are
formed on the small aggregated frames, and their p-values are column
expressions of ``tessera.functions.special`` beside them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import distributions as D
from tessera.functions.numeric import money_sum, round_half_even
from tessera.functions.quantiles import long_values, percentiles
from tessera.functions.special import anderson_darling_p, chi2_sf, f_sf, lilliefors_p, ln_normal_sf, normal_parts, pearson_p
from tessera.functions.windows import running_sum
from tessera.params import AbcParams
from tessera.session import materialize

# The columns of the descriptive table and of the normality tests.
DESC_COLS = ("age", "unit_price", "discount", "total_sales", "customer_rating", "quantity", "shipping_days")
NORMAL_COLS = ("age", "unit_price", "total_sales", "customer_rating", "discount")
#: Rows that the shared scan of the columns' samples keeps, as a multiple of the sample's size.
SAMPLE_SPARE = 4


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


# ------------------------------------------------------------------ A1
def describe(df: DataFrame, cols: Sequence[str] = DESC_COLS) -> DataFrame:
    """count, mean, median, std (n-1), min, max, population skewness and
    excess kurtosis per column."""
    cols = _present(df, cols)
    # the moments and the medians scan their columns three times; the view behind them is computed once
    df = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    lng = long_values(df, cols)
    mom = lng.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
        F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis"))
    med = percentiles(df, cols, [0.5]).select("column", F.col("value").alias("median"))
    r2 = lambda c: round_half_even(F.col(c), 2).alias(c)
    r3 = lambda c: round_half_even(F.col(c), 3).alias(c)
    return mom.join(med, "column").select(
        "column", "count", r2("mean"), r2("median"), r2("std"), r2("min"), r2("max"),
        r3("skewness"), r3("kurtosis"))


# ------------------------------------------------------------------ A3, A4
def group_moments(df: DataFrame, value: str, group: str) -> DataFrame:
    return (df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
              .groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                  F.var_samp(value).alias("var")))


def anova(df: DataFrame, value: str = "total_sales", group: str = "region") -> DataFrame:
    """A3: one-way ANOVA F and degrees of freedom."""
    return _anova(df, value, group).drop("_f")


def _anova(df: DataFrame, value: str = "total_sales", group: str = "region") -> DataFrame:
    """One-way ANOVA F from per-group n / mean / variance (numerically stable)."""
    g = group_moments(df, value, group)
    # a window over the bounded group table: the grand mean stands beside each group
    every = Window.partitionBy()
    gm = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(every), F.sum("n").over(every))
    parts = g.withColumn("gm", gm).agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("gm")) * (F.col("mean") - F.col("gm"))).alias("ssb"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"),
        F.count(F.lit(1)).alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("N"))
    dfb, dfw = (F.col("k") - 1), (F.col("N") - F.col("k"))
    f = F.try_divide(F.try_divide(F.col("ssb"), dfb), F.try_divide(F.col("ssw"), dfw))
    return parts.select(round_half_even(f, 4).alias("f_stat"), dfb.cast("long").alias("df_between"),
                        dfw.cast("long").alias("df_within"), f.alias("_f"))


def anova_test(df: DataFrame, value: str = "total_sales", group: str = "region") -> DataFrame:
    """A3 with p; without a second group or any spread within groups, p is null."""
    p = f_sf(F.col("_f"), F.col("df_between"), F.col("df_within"))
    return _with_p(_anova(df, value, group), p, ["f_stat", "df_between", "df_within"])


def _with_p(stats: DataFrame, p: Column, cols: Sequence[str], significant: bool = True) -> DataFrame:
    """``cols`` of a frame of statistics with p_value (4 places) and whether it is below 0.05."""
    out = stats.withColumn("_p", p).select(*cols, "_p")
    return out.select(*cols, round_half_even(F.col("_p"), 4).alias("p_value"),
                      *([(F.col("_p") < 0.05).alias("significant")] if significant else []))


def group_means(df: DataFrame, value: str = "total_sales", group: str = "region") -> DataFrame:
    """A4: mean per group, 2 dp."""
    return group_moments(df, value, group).select(group, round_half_even(F.col("mean"), 2).alias("mean"))


# ------------------------------------------------------------------ A5, A6
def contingency(df: DataFrame, a: str = "payment_method", b: str = "gender") -> DataFrame:
    """A5: dense a x b counts (missing combinations are 0).

    One aggregate by (a, b); the values of b (bounded by its domain) spread over
    the values of a make the missing combinations.
    """
    base = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    counts = base.groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))
    return dense(base, counts, a, b, "observed", 0)


def dense(base: DataFrame, cells: DataFrame, a: str, b: str, value: str, fill) -> DataFrame:
    """``cells`` with a row for every pair of values of a and b that occur in ``base``."""
    values = base.agg(F.sort_array(F.collect_set(b))).scalar()
    spine = base.select(a).distinct().select(a, F.explode(values).alias(b))
    return spine.join(cells, [a, b], "left").select(a, b, F.coalesce(value, F.lit(fill)).alias(value))


def chi_square(df: DataFrame, a: str = "payment_method", b: str = "gender") -> DataFrame:
    """Chi-square statistic and degrees of freedom."""
    return _chi_square(df, a, b).drop("_chi2")


def _chi_square(df: DataFrame, a: str = "payment_method", b: str = "gender") -> DataFrame:
    """Pearson chi-square of independence, Yates-corrected when dof = 1."""
    ct = contingency(df, a, b)
    cells = ct.select(F.col("observed").cast("double").alias("o"),
                      F.sum("observed").over(Window.partitionBy(a)).alias("ra"),
                      F.sum("observed").over(Window.partitionBy(b)).alias("cb"),
                      F.dense_rank().over(Window.orderBy(a)).alias("i"), F.dense_rank().over(Window.orderBy(b)).alias("j"))
    every = Window.partitionBy()  # over the bounded table of cells
    dof = (F.max("i").over(every) - 1) * (F.max("j").over(every) - 1)
    cells = cells.withColumns({"e": F.try_divide(F.col("ra") * F.col("cb"), F.sum("o").over(every)), "dof": dof})
    e, o = F.col("e"), F.col("o")
    corrected = o + F.signum(e - o) * F.least(F.lit(0.5), F.abs(e - o))
    o2 = F.when(F.col("dof") == 1, corrected).otherwise(o)
    stat = cells.agg(F.sum(F.try_divide((o2 - e) * (o2 - e), e)).alias("chi2"), F.max("dof").alias("dof"))
    return stat.select(round_half_even(F.col("chi2"), 4).alias("chi2_stat"),
                       F.col("dof").cast("long").alias("dof"), F.col("chi2").alias("_chi2"))


def chi_square_test(df: DataFrame, a: str = "payment_method", b: str = "gender") -> DataFrame:
    """A6 with p; without two values of both columns p is null."""
    return _with_p(_chi_square(df, a, b), chi2_sf(F.col("_chi2"), F.col("dof")), ["chi2_stat", "dof"])


# ------------------------------------------------------------------ A7, A8
def _pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def pearson(df: DataFrame, cols: Sequence[str] = DESC_COLS, listwise: bool = True) -> DataFrame:
    """Listwise-complete Pearson r per column pair (c1, c2, n, r)."""
    return _pearson(df, cols, listwise).drop("_r")


def _pearson(df: DataFrame, cols: Sequence[str] = DESC_COLS, listwise: bool = True) -> DataFrame:
    """A7 (listwise complete rows) / A8 (pairwise complete): r per column pair.

    One aggregate: a covariance per pair; the variances of listwise rows are
    shared by the pairs of a column. A column without spread has a null r."""
    cols = _present(df, cols)
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    if listwise:
        base = base.dropna()
    aggs = []
    for x, y in _pairs(cols):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        u, v = (F.col(x), F.col(y)) if listwise else (F.when(both, F.col(x)), F.when(both, F.col(y)))
        r = F.try_divide(F.covar_pop(u, v), F.sqrt(F.var_pop(u)) * F.sqrt(F.var_pop(v)))
        aggs.append(F.struct(F.lit(x).alias("c1"), F.lit(y).alias("c2"),
                             F.count(F.lit(1) if listwise else F.when(both, 1)).alias("n"), r.alias("r")))
    one = base.agg(F.array(*aggs).alias("a"))
    return one.select(F.inline("a")).select("c1", "c2", "n", round_half_even(F.col("r"), 3).alias("r"),
                                            F.col("r").alias("_r"))


def pearson_test(df: DataFrame, cols: Sequence[str] = DESC_COLS) -> DataFrame:
    """A7 with p; a constant column has a null r and a null p."""
    return _with_p(_pearson(df, cols), pearson_p(F.col("_r"), F.col("n")), ["c1", "c2", "n", "r"], significant=False)


def corr_matrix(df: DataFrame, cols=("age", "quantity", "unit_price", "discount", "total_sales",
                                     "customer_rating", "shipping_days")) -> DataFrame:
    """Pairwise-complete r, lower triangle (c1 after c2 in column order), 2 dp."""
    p = _pearson(df, cols, listwise=False)
    return p.select(F.col("c2").alias("row"), F.col("c1").alias("col"),
                    round_half_even(F.col("_r"), 2).alias("r"))


# ------------------------------------------------------------------ A9-A11
def abc(df: DataFrame, p: AbcParams = AbcParams(), product: str = "product_name",
        value: str = "total_sales") -> DataFrame:
    """Product revenue, inclusive cumulative share, tier A/B/C.

    Revenue is summed exactly as DECIMAL; the running total over the product
    ranking uses ``running_sum`` (range-partitioned, no single-task window).
    """
    rev = (df.where(F.col(product).isNotNull()).groupBy(product)
             .agg(F.sum(F.col(value).cast("decimal(18,2)")).alias("rev_dec")))
    total = F.lit(rev.agg(F.sum("rev_dec").cast("double")).first()[0]).cast("double")
    ranked = running_sum(rev, "rev_dec", [F.desc("rev_dec"), F.asc(product)], "cum_dec")
    share = F.try_divide(F.col("cum_dec").cast("double"), total)
    tier = F.when(share <= p.a_threshold, "A").when(share <= p.b_threshold, "B").otherwise("C")
    return ranked.select(F.col(product).alias("product"), F.col("rev_dec").cast("double").alias("revenue"),
                         round_half_even(share, 4).alias("cum_share"), tier.alias("abc_tier"))


def abc_tiers(abc_df: DataFrame) -> DataFrame:
    """Products and revenue per tier."""
    return abc_df.groupBy("abc_tier").agg(F.count(F.lit(1)).alias("products"),
                                          money_sum(F.col("revenue")).alias("revenue"))


# ------------------------------------------------------------------ A12, A13
def repeat_customers(df: DataFrame, customer: str = "customer_id", order: str = "order_id") -> DataFrame:
    """Customers, repeaters (>1 order rows), rate, mean and max orders."""
    per = (df.where(F.col(customer).isNotNull()).groupBy(customer)
             .agg(F.count(order).alias("n")))
    return per.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("n") > 1).alias("repeat_customers"),
        round_half_even(F.try_divide(F.count_if(F.col("n") > 1), F.count(F.lit(1))) * 100, 2).alias("repeat_rate_pct"),
        round_half_even(F.avg("n"), 2).alias("avg_orders"),
        F.max("n").alias("max_orders"))


def return_rate(df: DataFrame, group: str = "product_category", flag: str = "return_flag") -> DataFrame:
    """Returns, orders and return percent per category."""
    return (df.where(F.col(group).isNotNull()).groupBy(group)
              .agg(F.count_if(F.col(flag)).alias("return_count"), F.count(flag).alias("total_orders"))
              .withColumn("return_rate_pct",
                          round_half_even(F.try_divide("return_count", "total_orders") * 100, 2))
              .orderBy(F.desc("return_rate_pct"), group))


# ------------------------------------------------------------------ A35
def linear_fit(df: DataFrame, y: str = "total_sales", x: str = "discount", x_scale: float = 100.0) -> DataFrame:
    """Least-squares line of y on x (x as percent): slope, intercept, R2."""
    xs = F.col(x) * x_scale
    return df.agg(F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
                  round_half_even(F.regr_slope(F.col(y), xs), 4).alias("slope"),
                  round_half_even(F.regr_intercept(F.col(y), xs), 4).alias("intercept"),
                  round_half_even(F.regr_r2(F.col(y), xs), 6).alias("r2"))


# ------------------------------------------------------------------ A36, A2
def key_text(cols: Sequence[str]):
    """The key columns as one text: the same in SQL engines (nulls are empty)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def row_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible n-row sample, the n rows with the smallest md5 of (seed, key).

    ``orderBy(...).limit(n)`` is TakeOrderedAndProject: each task keeps its n
    best rows, so at most n x tasks rows reach the final merge.
    """
    h = F.md5(F.concat(F.lit(f"{seed}|"), key_text(key_cols)))
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(n).drop("_h")


def normality_sample(df: DataFrame, cols: Sequence[str] = NORMAL_COLS, sample_size: int = 500,
                     key_cols: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """The (column, v) rows that A2 tests: a bounded sample of each column's values."""
    cols = _present(df, cols)
    keys = list(key_cols) or [c for c in df.columns if c not in cols][:4]
    values = {f"_v{i}": F.col(c).cast("double") for i, c in enumerate(cols)}
    rows = df.select(*keys, *[F.when(~F.isnan(v), v).alias(n) for n, v in values.items()])
    # one scan for all columns: if the first rows hold sample_size values of a column, these are its sample
    first = materialize(row_sample(rows, SAMPLE_SPARE * sample_size, keys, seed))
    found = first.agg(F.count(F.lit(1)).alias("rows"), *[F.count(n).alias(n) for n in values]).first()
    parts = []
    for n, c in zip(values, cols):
        # a column with too few values there gets a scan of its own, unless these are all rows
        enough = found[n] >= sample_size or found["rows"] < SAMPLE_SPARE * sample_size
        s = (first if enough else rows).where(F.col(n).isNotNull()).select(*keys, F.col(n).alias("v"))
        parts.append(row_sample(s, sample_size, keys, seed).select(F.lit(c).alias("column"), "v"))
    sample = parts[0]
    for x in parts[1:]:
        sample = sample.unionByName(x)
    return sample


def normality(df: DataFrame, cols: Sequence[str] = NORMAL_COLS, sample_size: int = 500,
              key_cols: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """A2: Shapiro-Wilk W and p on a <= sample_size hash sample per column.

    The sample of each column is a bounded top-n (see ``row_sample``); the test
    runs per column in ``applyInPandas`` on at most ``sample_size`` values.
    """
    sample = normality_sample(df, cols, sample_size, key_cols, seed)

    def test(pdf):
        import pandas as pd
        w, p = D.shapiro_wilk(pdf["v"].to_numpy())
        return pd.DataFrame({"column": [pdf["column"].iloc[0]], "n": [len(pdf)],
                             "W_stat": [round(w, 4)], "p_value": [round(p, 4)],
                             "normal": ["Yes" if p > 0.05 else "No"]})
    return sample.groupBy("column").applyInPandas(
        test, "column string, n long, W_stat double, p_value double, normal string")


def jarque_bera(df: DataFrame, cols: Sequence[str] = NORMAL_COLS) -> DataFrame:
    """Full-data normality companion: JB = n/6 (S^2 + K^2/4), p = exp(-JB/2)."""
    lng = long_values(df, _present(df, cols))
    m = lng.groupBy("column").agg(F.count("v").alias("n"), F.skewness("v").alias("s"),
                                  F.kurtosis("v").alias("k"))
    jb = F.col("n") / 6.0 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4.0)
    return m.select("column", "n", round_half_even(jb, 4).alias("jb_stat"),
                    round_half_even(F.exp(-jb / 2.0), 4).alias("p_value"))


def normality_full(df: DataFrame, cols: Sequence[str] = NORMAL_COLS) -> DataFrame:
    """A2 over all rows: Anderson-Darling and Lilliefors tests of each column.

    Both compare the ranks of all values with a normal of the column's own mean
    and standard deviation, so their p-values are those for estimated parameters
    (a plain Kolmogorov-Smirnov p is far too large then). Equal values fall
    together with their count; their ranks come from running totals over range
    slices, so no column is sorted in one task. Nulls and NaN are left out; a
    column of fewer than five values, without spread, or with an infinite value
    has null results.
    """
    cols = _present(df, cols)
    counts = materialize(long_values(df, cols).groupBy("column", "v").agg(F.count(F.lit(1)).alias("c")))
    ranked = running_sum(counts, "c", [F.col("v")], "upto", partition_by=["column"])
    # moments round the least value, as sums of counts: no second pass over the rows
    m = counts.groupBy("column").agg(F.sum("c").alias("n"), F.min("v").alias("x0"), F.max("v").alias("x1"))
    off = counts.join(F.broadcast(m), "column").withColumn("u", F.col("v") - F.col("x0"))  # one row per column
    m = off.groupBy("column", "n", "x0", "x1").agg((F.sum(F.col("c") * F.col("u")) / F.first("n")).alias("mu"))
    dev = F.col("v") - F.col("x0") - F.col("mu")
    m = counts.join(F.broadcast(m), "column").groupBy("column", "n", "x0", "x1", "mu").agg(
        F.sqrt(F.sum(F.col("c") * dev * dev) / (F.first("n") - 1)).alias("sd"))
    ok = (F.col("n") >= 5) & (F.col("sd") > 0) & (F.col("x1") < float("inf")) & (F.col("x0") > -float("inf"))
    x = ranked.join(F.broadcast(m.withColumn("ok", ok)), "column").withColumn("z", F.when(F.col("ok"), dev / F.col("sd")))
    x = x.withColumns(dict(zip(("_near", "_far"), normal_parts(F.col("z")))))
    parts = F.col("_near"), F.col("_far")
    x = x.withColumns({"above": ln_normal_sf(F.col("z"), parts), "under": ln_normal_sf(-F.col("z"), parts)})
    n, c, hi = (F.col(k).cast("double") for k in ("n", "c", "upto"))
    lo = hi - c
    # ranks lo+1 .. hi of equal values: their weights 2i - 1 add up to hi^2 - lo^2, those from the other end likewise
    a2 = -F.first(n) - F.sum(c * (lo + hi) * F.col("under") + c * (2 * n - lo - hi) * F.col("above")) / F.first(n)
    cdf = F.exp("under")
    d = F.max(F.greatest(hi / n - cdf, cdf - lo / n))
    out = x.groupBy("column").agg(F.first("n").alias("n"), a2.alias("a2"), d.alias("d"))
    out = out.withColumns({"pa": anderson_darling_p(F.col("a2"), F.col("n")), "pl": lilliefors_p(F.col("d"), F.col("n"))})
    known = F.col("a2").isNotNull()
    return out.select("column", "n", round_half_even(F.col("a2"), 4).alias("ad_stat"),
                      F.when(known, round_half_even(F.col("pa"), 4)).alias("ad_p"), round_half_even(F.col("d"), 6).alias("lf_stat"),
                      F.when(known, round_half_even(F.col("pl"), 4)).alias("lf_p"),
                      F.when(known, F.when(F.col("pa") > 0.05, "Yes").otherwise("No")).alias("normal"))


def ks_normal(df: DataFrame, cols: Sequence[str] = NORMAL_COLS) -> DataFrame:
    """The Kolmogorov-Smirnov distance of each column to its own normal, with its Lilliefors p."""
    return normality_full(df, cols).select("column", F.col("lf_stat").alias("ks_stat"), F.col("lf_p").alias("p_value"))


def run_analysis(df: DataFrame, p: AbcParams = AbcParams()) -> dict[str, DataFrame]:
    """The eight analyses as named DataFrames (lazy)."""
    a = abc(df, p)
    return {
        "descriptive": describe(df), "normality": normality(df, key_cols=("order_id", "product_name")),
        "anova": anova_test(df), "region_means": group_means(df), "chi_square": chi_square_test(df),
        "correlations": pearson_test(df), "abc": a, "abc_tiers": abc_tiers(a),
        "repeat": repeat_customers(df), "returns": return_rate(df),
    }
