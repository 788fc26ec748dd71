"""Every operator of the cleaning and analysis sections on empty, all-null, constant and single-group input."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.operators import distributions as DI
from tessera.operators import features as M
from tessera.operators import marts
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.session import materialize

SCHEMA = ("order_id long, customer_id long, customer_name string, age double, gender string, city string, state string, "
          "region string, loyalty_tier string, product_category string, product_name string, quantity int, "
          "unit_price double, discount double, total_sales double, order_date string, payment_method string, "
          "customer_rating double, return_flag boolean, shipping_days double")


def row(i, **kw):
    base = dict(order_id=i, customer_id=i, customer_name="n", age=30.0, gender="Male", city="c", state="s", region="R",
                loyalty_tier="gold", product_category="P", product_name="p", quantity=1, unit_price=10.0, discount=0.0,
                total_sales=10.0, order_date="2023-01-01", payment_method="UPI", customer_rating=3.0, return_flag=False,
                shipping_days=2.0)
    return tuple({**base, **kw}.values())


NULLS = dict(age=None, gender=None, city=None, region=None, loyalty_tier=None, product_category=None, quantity=None,
             unit_price=None, discount=None, total_sales=None, order_date=None, payment_method=None, customer_rating=None,
             return_flag=None, shipping_days=None)
CASES = {"empty": [], "constant": [row(i, total_sales=0.0, region="RQ"[i % 2]) for i in range(3)], "nulls": [row(1, **NULLS), row(2, **NULLS)],
         "invalid": [row(1, order_date="x", quantity=-2, customer_rating=9.0), row(1, order_date="x", quantity=-2, customer_rating=9.0)]}


@pytest.fixture(scope="module", params=list(CASES))
def raw(spark, request):
    return spark.createDataFrame(CASES[request.param], SCHEMA)


def test_cleaning(raw):
    n = raw.distinct().count()
    for step in (C.remove_duplicates, C.fix_dates, C.standardise_categoricals, C.fix_invalid_values, C.impute_missing,
                 C.cap_outliers, C.value_audit, lambda d: C.iqr_bounds(d, ["unit_price"]), Q.raw_profile,
                 lambda d: C.type_cast(C.recompute_derived(C.fix_dates(d)))):
        step(raw).collect()
    assert C.zscore_count(raw).first()[0] == 0
    got = C.clean_sales(raw)
    assert got.clean.count() == n and got.validation.count() == 6
    report = got.report.first()
    assert report.raw_rows == raw.count() and report.final_rows == n and 0 <= report.dq_score <= 100
    got.issues.collect()


@pytest.mark.parametrize("case", ["nulls", "constant"])
def test_statistics_and_marts(spark, case):
    raw = spark.createDataFrame(CASES[case], SCHEMA)
    clean = materialize(C.clean_sales(raw).clean)  # the operators are planned over a table, not over the whole chain
    for op in (S.describe, S.anova, S.anova_test, S.group_means, S.contingency, S.chi_square, S.chi_square_test, S.pearson,
               S.pearson_test, S.corr_matrix, S.abc, S.repeat_customers, S.return_rate, S.linear_fit, S.jarque_bera,
               lambda d: S.row_sample(d, 5, ["order_id"]), lambda d: S.normality(d, key_cols=["order_id"]), S.ks_normal,
               marts.kpis, marts.top_entities, marts.yearly_growth, marts.regional, marts.loyalty, marts.category_share,
               marts.monthly, lambda d: marts.split(d, "payment_method", True), marts.quarter_yoy, marts.region_category,
               marts.top_products, DI.rating_buckets, DI.histogram, DI.kde, DI.kde_by, DI.violin, DI.box,
               M.daily, M.features, M.loyalty_tier):
        op(clean).collect()


def test_a_group_of_one_row_stays_in_the_densities(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "product_category string, unit_price double")
    got = DI.kde_by(df, grid=10).collect()
    b = [r for r in got if r.product_category == "b"]
    assert len(got) == 20 and len(b) == 10 and all(r.density is None and r.x == 5.0 for r in b)


def test_constant_columns(spark):
    df = spark.createDataFrame([(5.0, 0.1, 9.0)] * 4, "age double, discount double, total_sales double")
    h = DI.histogram(df).where("count > 0").collect()
    assert len(h) == 3 and all(r["count"] == 4 for r in h)
    assert all(r.density is None for r in DI.kde(df).collect())
    ks = S.ks_normal(df, ["age"]).first()
    assert ks["column"] == "age" and ks.p_value is None


def test_an_order_line_without_its_order_stays(spark, tmp_path):
    from tessera.sources import sales
    src = "/root/testdata/sf0.001"
    for t in ("orders", "customer", "part", "nation", "region", "lineitem"):
        df = spark.read.parquet(f"{src}/{t}.parquet")
        (df.where("o_orderkey > 20") if t == "orders" else df).write.parquet(f"{tmp_path}/{t}.parquet")
    got = sales(spark, str(tmp_path))
    assert got.count() == spark.read.parquet(f"{src}/lineitem.parquet").count()
    assert got.where("order_id IS NULL AND region IS NULL").count() > 0
