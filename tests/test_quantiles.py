import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions.quantiles import percentiles
from tessera.functions.windows import running_sum
from pyspark.sql import functions as F


def _check(spark, pdf, probs, **kw):
    df = spark.createDataFrame(pdf)
    got = percentiles(df, ["x"], probs, by=["g"], **kw).toPandas()
    for _, r in got.iterrows():
        s = pdf.loc[pdf.g == r.g, "x"].dropna().to_numpy()
        assert np.isclose(np.quantile(s, r.prob), r.value, rtol=1e-12, atol=1e-12)


def test_exact_with_refinement_and_hot_value(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "x": rng.lognormal(2, 2, 5000)})
    pdf.loc[:1800, "x"] = 3.0   # a third of the rows share one value
    _check(spark, pdf, [0.0, 0.25, 0.5, 0.75, 1.0], sketch=8)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_property_matches_numpy(spark, xs):
    pdf = pd.DataFrame({"g": [0] * len(xs), "x": xs})
    _check(spark, pdf, [0.1, 0.5, 0.9], sketch=8)


def test_running_sum_hot_key_and_partition_invariance(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.4, 0, rng.integers(1, 50, n)),
                        "o": np.arange(n), "v": rng.integers(0, 100, n)})
    exp = pdf.sort_values(["k", "o"]).groupby("k")["v"].cumsum()
    for parts in (1, 7):
        df = spark.createDataFrame(pdf).repartition(parts)
        got = running_sum(df, "v", [F.col("o")], "cum", partition_by=["k"], num_partitions=parts + 3).toPandas()
        got = got.set_index("o").sort_index()
        assert (got["cum"].to_numpy() == exp.sort_index().to_numpy()).all()


def test_running_sum_keeps_every_row_however_it_is_planned(spark):
    """More columns than the sums need, null keys and values, no exchange reuse, few and many slices."""
    rng = np.random.default_rng(4)
    n = 4000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.4, 0, rng.integers(1, 30, n)), "o": np.arange(n),
                        "v": rng.integers(0, 100, n), "extra": rng.random(n)})
    df = spark.createDataFrame(pdf).withColumns({"k": F.expr("nullif(k, 7)"), "v": F.expr("if(o % 50 = 0, null, v)")})
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.o: (r.k, r.extra, r.c) for r in df.withColumn("c", F.sum("v").over(w)).collect()}
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        for parts in (1, 8, 200):
            got = running_sum(df, "v", [F.col("o")], "c", partition_by=["k"], num_partitions=parts).collect()
            assert len(got) == n and {r.o: (r.k, r.extra, r.c) for r in got} == want
    spark.conf.unset("spark.sql.exchange.reuse")
    one = running_sum(df, "v", [F.desc("o")], "c", num_partitions=8).where("o = 1").first()
    assert one.c == df.where("o >= 1").agg(F.sum("v")).first()[0]


def test_selection_ends_on_infinite_huge_and_tiny_values(spark):
    inf = float("inf")
    xs = [inf, -inf, -inf, 1.0, 2.0, 3.0, 1.7e308, -1.7e308, 5e-324, 0.0, -0.0, 1e-300]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.prob: r for r in percentiles(df, ["x"], [i / 11 for i in range(12)], sketch=8).collect()}
    s = sorted(xs)
    for i in range(12):
        pos = i / 11 * 11
        assert got[i / 11].lower == s[int(np.floor(pos))] and got[i / 11].higher == s[int(np.ceil(pos))]


def test_same_result_at_every_size(spark):
    for n in (1, 2, 7, 60, 5000):
        df = spark.range(n).select((F.col("id") * 7 % 1013).cast("double").alias("x"))
        want = np.quantile([i * 7 % 1013 for i in range(n)], [0, .3, .5, 1])
        got = {r.prob: r.value for r in percentiles(df, ["x"], [0.0, .3, .5, 1.0], sketch=16).collect()}
        assert np.allclose([got[p] for p in (0.0, .3, .5, 1.0)], want)


def test_at_most_three_scans_whatever_the_spread(spark):
    """Skewed, constant and infinite columns; without slack windows are missed and a third scan opens them."""
    rng = np.random.default_rng(11)
    n = 20_000
    pdf = pd.DataFrame({"skewed": np.exp(rng.normal(0, 30, n)), "constant": 4.0, "few": rng.integers(0, 3, n) / 1.0,
                        "wide": np.where(rng.random(n) < 0.3, np.inf, rng.normal(size=n)), "_by0": rng.integers(0, 4, n),
                        "none": np.nan})
    probs = [0.0, 0.013, 0.25, 0.5, 0.75, 0.999, 1.0]
    cols = ["skewed", "constant", "few", "wide", "none"]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    source = spark.createDataFrame(pdf).repartition(4)
    df = source.mapInPandas(count, source.schema)
    for kw, scans in (({}, 2), ({"sketch": 8, "slack": 0.0}, 3)):
        before = seen.value
        got = {(r["column"], r.prob): r for r in percentiles(df, cols, probs, **kw).collect()}
        assert seen.value - before <= scans * n
        assert {c for c, _ in got} == set(cols) - {"none"}
        for c in cols[:-1]:
            s = np.sort(pdf[c])
            for p in probs:
                pos = p * (n - 1)
                assert got[c, p].lower == s[int(np.floor(pos))] and got[c, p].higher == s[int(np.ceil(pos))]
    by = {(r["_by0"], r["column"], r.prob): r.value for r in percentiles(df, ["few", "skewed"], [0.3], by=["_by0"], sketch=8, slack=0.0).collect()}
    for g, part in pdf.groupby("_by0"):
        for c in ("few", "skewed"):
            assert np.isclose(by[g, c, 0.3], np.quantile(part[c], 0.3), rtol=1e-12)


def test_groups_may_be_null_and_tables_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None), ("b", None)], "g string, x double")
    assert {(r.g, r.value) for r in percentiles(df, ["x"], [0.5], by=["g"]).collect()} == {(None, 2.0), ("a", 5.0)}
    assert percentiles(df.limit(0), ["x"], [0.5], by=["g"]).collect() == percentiles(df.limit(0), ["x"], [0.5]).collect() == []
