import numpy as np
import pandas as pd

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.functions import distributions as D
from tessera.functions import special as SP
from tessera.operators import stats as S


def val(c):
    """The value of a column expression without a table."""
    return SparkSession.active().range(1).select(c.alias("v")).first().v


def test_pvalues_reproduce_recorded_report(spark):
    # values recorded in the reference's statistical report
    assert round(val(SP.f_sf(1.1125, 4, 3001)), 4) == 0.3487
    assert round(val(SP.chi2_sf(2.2552, 4)), 4) == 0.6889


def test_pvalue_known_values(spark):
    assert abs(val(SP.chi2_sf(3.841458820694124, 1)) - 0.05) < 1e-9
    assert abs(val(SP.t_two_sided(2.0, 10)) - 0.07338803477074) < 1e-9
    assert abs(val(SP.f_sf(4.0, 2, 10)) - 1.8 ** -5) < 1e-12   # closed form for d1 = 2


def test_shapiro_wilk_behaviour():
    rng = np.random.default_rng(0)
    w, p = D.shapiro_wilk(rng.normal(size=300))
    assert 0.98 < w <= 1.0 and p > 0.05
    w2, p2 = D.shapiro_wilk(rng.exponential(size=300))
    assert w2 < 0.95 and p2 < 1e-6


def test_chi_square_yates_2x2(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 15
    df = spark.createDataFrame(rows, "payment_method string, gender string")
    got = S.chi_square(df).first()
    o = np.array([[10, 20], [30, 15]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    d = e - o
    oc = o + np.sign(d) * np.minimum(0.5, np.abs(d))
    assert got["dof"] == 1
    assert got["chi2_stat"] == round(float(((oc - e) ** 2 / e).sum()), 4)


def test_abc_boundary_crossing_product_is_b(spark):
    rows = [("p1", 50.0), ("p2", 15.0), ("p3", 10.0), ("p4", 10.0), ("p5", 10.0), ("p6", 5.0)]
    df = spark.createDataFrame(rows, "product_name string, total_sales double")
    got = {r["product"]: r["abc_tier"] for r in S.abc(df).collect()}
    # cum shares: .50 .65 .75 .85 .95 1.0 -> A A B B C C
    assert got == {"p1": "A", "p2": "A", "p3": "B", "p4": "B", "p5": "C", "p6": "C"}


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"age": rng.normal(40, 10, 500).round(), "quantity": rng.integers(1, 6, 500)})
    got = {r["column"]: r for r in S.describe(spark.createDataFrame(pdf), ["age", "quantity"]).collect()}
    for c in ("age", "quantity"):
        s = pdf[c].astype(float)
        assert got[c]["median"] == round(float(s.median()), 2)
        assert abs(got[c]["std"] - s.std()) < 0.006
        m2 = ((s - s.mean()) ** 2).mean()
        assert abs(got[c]["skewness"] - ((s - s.mean()) ** 3).mean() / m2 ** 1.5) < 0.0006


def test_row_sample_partition_invariant(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = sorted(r[0] for r in S.row_sample(df.repartition(1), 50, ["k"]).collect())
    b = sorted(r[0] for r in S.row_sample(df.repartition(9), 50, ["k"]).collect())
    assert a == b and len(a) == 50


def test_null_group_keys_are_dropped(spark):
    from tessera.operators import marts
    rows = [("N", 10.0, 1, 4.0), (None, 99.0, 2, 3.0), ("S", 5.0, 3, 2.0)]
    df = spark.createDataFrame(rows, "region string, total_sales double, order_id long, customer_rating double")
    got = {r["region"]: r["revenue"] for r in marts.regional(df).collect()}
    assert got == {"N": 10.0, "S": 5.0}


def test_ks_normal_separates_normal_from_skewed(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"age": rng.normal(40, 5, 2000), "unit_price": rng.exponential(100, 2000)})
    got = {r["column"]: r for r in S.ks_normal(spark.createDataFrame(pdf), ["age", "unit_price"]).collect()}
    assert got["age"]["p_value"] > 0.01
    assert got["unit_price"]["p_value"] < 1e-6


def test_pvalues_with_very_many_rows(spark):
    import math
    from statistics import NormalDist
    n = 1e12
    want = 2 * (1 - NormalDist().cdf(1.96))
    assert abs(val(SP.t_two_sided(1.96, n)) - want) < 1e-7
    x = 2.0 * 4 / 2
    assert abs(val(SP.f_sf(2.0, 4, n)) - math.exp(-x) * (1 + x)) < 1e-7
    r = 1.96 / math.sqrt(n)
    assert abs(val(SP.pearson_p(r, n)) - want) < 1e-7
    assert val(SP.f_sf(None, 4, 9)) is None and val(SP.chi2_sf(1.0, 0)) is None and val(SP.pearson_p(0.1, 2)) is None


def test_shapiro_wilk_published_value():
    # men's weights of the 1965 paper: W = 0.79
    w, p = D.shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert abs(w - 0.7888) < 5e-4 and abs(p - 0.0067) < 5e-4


def test_special_functions_equal_the_math_library(spark):
    """Against the library in Spark's JVM, over small and large parameters and both sides of the mean."""
    lib = spark.sparkContext._jvm.org.apache.commons.math3.special
    rows = [(x, a, b) for a in (0.5, 1.0, 5.0, 50.0, 3e3) for b in (0.5, 2.0, 7.5, 400.0)
            for x in (1e-9, 0.001, 0.3, 0.8, 0.99, a / (a + b))]
    df = spark.createDataFrame(rows, "x double, a double, b double")
    for r in df.select("*", SP.beta_regularised(F.col("x"), 1 - F.col("x"), F.col("a"), F.col("b")).alias("v")).collect():
        assert abs(r.v - lib.Beta.regularizedBeta(r.x, r.a, r.b, 1e-15, 100_000)) < 1e-10
    rows = [(a, a * m) for a in (0.5, 1.0, 5.5, 50.0, 3e3) for m in (1e-6, 0.5, 0.999, 1.0, 1.001, 2.0, 10.0)]
    for r in spark.createDataFrame(rows, "a double, x double").select("*", SP.gamma_upper(F.col("a"), F.col("x")).alias("v")).collect():
        assert abs(r.v - lib.Gamma.regularizedGammaQ(r.a, r.x, 1e-15, 100_000)) < 1e-10
    # published tables: upper 5 % points
    for x, k in ((5.991464547107979, 2), (18.307038053275146, 10), (124.34211340400407, 100)):
        assert abs(val(SP.chi2_sf(x, k)) - 0.05) < 1e-10
    for t, k in ((12.706204736432095, 1), (2.2281388519649385, 10), (1.9839715184496334, 100)):
        assert abs(val(SP.t_two_sided(t, k)) - 0.05) < 1e-10
    assert 1e-27 < val(SP.t_two_sided(40.0, 30)) < 2e-27  # far tails keep their digits
    zs = [-37.0, -8.0, -2.5, -1.0, 0.0, 0.3, 2.4999, 2.5001, 8.0, 37.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", SP.ln_normal_sf(F.col("z")).alias("v")).collect()
    import math
    assert all(r.v == pytest.approx(math.log(math.erfc(r.z / math.sqrt(2)) / 2), rel=1e-12, abs=1e-15) for r in got)


def test_p_values_are_columns(spark, capsys):
    df = spark.createDataFrame([(float(i), float(i * i % 7), "ab"[i % 2]) for i in range(30)], "age double, quantity double, region string")
    assert S.pearson_test(df, ["age", "quantity"]).collect()[0].p_value is not None
    S.pearson_test(df, ["age", "quantity"]).explain()
    assert "ExistingRDD" in capsys.readouterr().out  # the plan starts at the data, not at collected statistics
    one = df.select("age", F.lit("x").alias("region"))
    assert S.anova_test(one, "age").first().p_value is None
    assert S.pearson_test(df.withColumn("quantity", F.lit(1.0)), ["age", "quantity"]).first()[-2:] == (None, None)


def brute_normality(x):
    import math
    x = np.sort(x)
    n = len(x)
    z = (x - x.mean()) / x.std(ddof=1)
    lo = np.array([math.log(math.erfc(-v / math.sqrt(2)) / 2) for v in z])
    hi = np.array([math.log(math.erfc(v / math.sqrt(2)) / 2) for v in z])
    i = np.arange(1, n + 1)
    cdf = np.exp(lo)
    return (-n - np.sum((2 * i - 1) * (lo + hi[::-1])) / n,
            max(np.max(i / n - cdf), np.max(cdf - (i - 1) / n)))


def test_normality_over_all_rows(spark):
    rng = np.random.default_rng(8)
    cols = {"age": rng.normal(size=800), "unit_price": rng.lognormal(size=800), "discount": rng.integers(0, 5, 800) / 1.0,
            "total_sales": 1e9 + rng.normal(size=800)}
    pdf = pd.DataFrame(cols).assign(customer_rating=2.0)
    pdf.loc[:9, "age"] = np.nan
    got = {r["column"]: r for r in S.normality_full(spark.createDataFrame(pdf).repartition(5)).collect()}
    for c in cols:
        a, d = brute_normality(pdf[c].dropna().to_numpy())
        assert got[c].ad_stat == pytest.approx(a, abs=2e-4) and got[c].lf_stat == pytest.approx(d, abs=2e-6)
    assert got["age"].n == 790 and got["age"].normal == "Yes" == got["total_sales"].normal and got["age"].ad_p > 0.05 < got["age"].lf_p
    assert got["unit_price"].normal == "No" and got["unit_price"].lf_p == 0.0 == got["unit_price"].ad_p
    assert got["customer_rating"][2:] == (None,) * 5
    few = spark.createDataFrame([(1.0, float("inf"))] * 3 + [(2.0, 1.0)] * 3, "age double, discount double")
    assert {r["column"]: r.ad_stat for r in S.normality_full(few).collect()}["discount"] is None
    assert S.normality_full(few.limit(0)).collect() == []


def test_lilliefors_and_anderson_published(spark):
    # critical values at 5 %: 0.895 / sqrt(n) for D (Lilliefors, large n), 0.752 for the modified A2
    assert abs(val(SP.lilliefors_p(0.895 / np.sqrt(1000.0), 1000)) - 0.05) < 0.008
    assert abs(val(SP.anderson_darling_p(0.752, 1e9)) - 0.05) < 0.002
