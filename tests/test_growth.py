"""What keeps work, shuffles and a task's memory in step with the input: views are joined once, and narrow before wide."""

import math
import os
import re
import shutil
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.functions.special import ln_normal_sf, normal_parts
from tessera.functions.text import py_strip
from tessera.operators import clean as C
from tessera.operators import stats as S
from tessera.plans import catalog
from tessera.session import SHUFFLE_CLEANUP, materialize, materialize_each
from tessera.sources import tables

KEY = ("id",)


@pytest.fixture()
def written(spark, tmp_path):
    """Rows in one file: age is mostly null, its few values lie anywhere in the order of the hashes."""
    i = F.col("id")
    spark.range(900).select(
        "id", F.when(i % 60 == 7, i.cast("double")).alias("age"), F.when(i % 5 != 0, i * 2.0).alias("unit_price"),
        F.when(i % 7 == 0, F.lit(float("nan"))).otherwise(i * 3.0).alias("discount"), F.lit(None).cast("double").alias("customer_rating"),
        F.when(i % 3 == 0, "m").when(i % 3 == 1, "f").alias("gender")).coalesce(1).write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def scanned(df, source) -> bool:
    return bool(set(df.inputFiles()) & set(source.inputFiles()))


def exchanges(df, marker: str) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange" in x and marker in x]


def test_lines_are_not_shuffled_by_customer(spark):
    """Only orders meet customer; behind the join with orders nothing else is joined to the lines."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for view in (tables.sales, tables.sales_raw):
            plan = view(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
            joins = [x for x in plan.splitlines() if "Join LeftOuter" in x]
            assert "l_orderkey" in joins[0] and "o_orderkey" in joins[0]
            lines = exchanges(view(spark, SF_SMALL), "hashpartitioning(l_")
            assert len(lines) == 2  # by part and by order
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_rows_are_dealt_by_the_size_of_lineitem(spark, monkeypatch):
    """The number of partitions follows the bytes of lineitem, and the rows are the same."""
    before = tables.sales_raw(spark, SF_SMALL)
    size = os.path.getsize(f"{SF_SMALL}/lineitem.parquet")
    monkeypatch.setattr(tables, "RAW_PARTITION_BYTES", size // 20)
    dealt = tables.sales_raw(spark, SF_SMALL)
    assert exchanges(dealt, "REPARTITION_BY_NUM") and not exchanges(before, "REPARTITION_BY_NUM")
    assert dealt.rdd.getNumPartitions() >= 20
    assert dealt.exceptAll(before).count() == 0 and before.exceptAll(dealt).count() == 0


@pytest.mark.parametrize("size", [5, 20, 500])
def test_samples_of_all_columns_by_one_scan(spark, written, size):
    """the sample of each column is that of a scan of its own, also of a sparse, an empty and a NaN column."""
    cols = ("age", "unit_price", "discount", "customer_rating")
    got = S.normality_sample(written, cols, size, KEY)
    for c in cols:
        own = written.where(F.col(c).isNotNull() & ~F.isnan(c)).select("id", F.col(c).alias("v"))
        want = sorted(r.v for r in S.row_sample(own, size, KEY).collect())
        assert sorted(r.v for r in got.where(F.col("column") == c).collect()) == want
    full = S.normality_sample(written, ("unit_price", "discount"), size, KEY)
    assert not scanned(full, written)  # no scan for each column behind the shared one


def test_describe_computes_its_view_once(spark, written):
    """F6, F11"""
    got = S.describe(written)
    assert not scanned(got, written)
    row = {r.column: r for r in got.collect()}
    assert set(row) == {"age", "unit_price", "discount"} and row["age"]["count"] == 15


def test_impute_computes_its_frame_once(spark, written):
    """F18"""
    got = C.impute_missing(written)
    assert not scanned(got, written)
    assert got.where("age IS NULL OR gender IS NULL").count() == 0 and got.count() == 900


def test_forecast_reads_a_table_of_its_columns(spark, tmp_path):
    """The features, the encoders and the medians do not join the tables again."""
    for t in ("lineitem", "orders", "customer", "part", "nation", "region"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    _, s = catalog.fitted(spark, str(tmp_path))
    assert s.columns == list(catalog.FORECAST_COLS)
    assert not any(str(tmp_path) in f for f in s.inputFiles())


def test_clean_rows_are_written_once_and_read_by_column(spark, monkeypatch):
    """the deduplicated frame is written; the clean frame is a projection of it, pruned by what reads it."""
    written = []
    monkeypatch.setattr(C, "materialize", lambda df, mode="checkpoint": written.append(df.columns) or materialize(df, mode))
    res = C.clean_sales(tables.sales_raw(spark, SF_SMALL))
    assert len(written) == 1 and "_mult" in written[0]
    cities = res.clean.select("city")
    plan = cities._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<city:string>" in plan
    assert set(cities.inputFiles()) == set(res.clean.inputFiles())
    assert cities.where("city IS NULL").count() == 0 and not any(c.startswith("_") for c in res.clean.columns)
    assert res.report.first().final_rows == res.clean.count()


def test_strip_is_that_of_python(spark):
    """a text between visible characters is not searched; all others are stripped as before."""
    texts = ["", " ", "a", "~", "~~", "!a~", " a", "a ", "\ta b\n", "\u00a0é\u3000", "é a", "a é", "a\x1f", "\x85a", "\x7fa\x7f", "日本 ", "a\u2003", "\u2003~", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", py_strip(F.col("t")).alias("s"))
    assert [r.s for r in df.collect()] == [t.strip() if t is not None else None for t in texts]
    plan = C.standardise_gender(df.select("t").withColumn("t", F.upper("t")), "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("END AS t") == 1 and plan.count("trim(") == 1  # not once for each column that follows from the stripped text


def test_normal_tails_are_compiled(spark):
    """the JVM never compiles a method of over 8000 bytes; both tails of a value share the series and the fraction."""
    x = spark.range(40).select((F.col("id") / 4 - 5).alias("z"))
    parts = normal_parts(F.col("z"))
    both = x.select("z", parts[0].alias("a"), parts[1].alias("b")).select(
        "z", *[ln_normal_sf(t, (F.col("a"), F.col("b"))).alias(n) for t, n in ((F.col("z"), "above"), (-F.col("z"), "under"))],
        ln_normal_sf(-F.col("z")).alias("alone"))
    code = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(
        both._jdf.queryExecution().executedPlan())
    assert all(int(n) <= 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
    for r in both.collect():
        assert r.under == r.alone and abs(math.exp(r.above) - math.erfc(r.z / math.sqrt(2)) / 2) < 1e-14
        assert abs(math.exp(r.above) + math.exp(r.under) - 1) < 1e-14


def shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(blocks.size()) if (f := blocks.apply(i).getName()).startswith("shuffle_")}


def test_copies_are_found_where_the_join_left_them(spark, monkeypatch):
    """behind the join with orders no row is shuffled, and a share of the lines meets its share of the orders."""
    size = os.path.getsize(f"{SF_SMALL}/lineitem.parquet")
    monkeypatch.setattr(tables, "SHARE_BYTES", size // 3 + 1)
    monkeypatch.setattr(tables, "RAW_PARTITION_BYTES", size // 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shares = tables.raw_shares(spark, SF_SMALL)
        assert len(shares) == 3
        counted = C.count_copies(C.nan_to_null(shares[1]), tables.LINE_ORDER)
        dealt = [re.search(r"hashpartitioning\((\w+)#", x)[1] for x in exchanges(counted, "hashpartitioning")]
        assert sorted(dealt) == ["c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]
        plan = counted._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"pmod\(xxhash64\(l_orderkey#\d+L, 42\), 3\) = 1", plan) and re.search(r"pmod\(xxhash64\(o_orderkey#\d+L, 42\), 3\) = 1", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(tables, "SHARE_BYTES", 1)
    assert len(tables.raw_shares(spark, SF_SMALL)) == tables.SHARES  # the scans do not grow with the table
    assert sum(s.count() for s in tables.raw_shares(spark, SF_SMALL)) == tables.sales_raw(spark, SF_SMALL).count()


def test_shares_give_the_rows_of_the_whole(spark, tmp_path, monkeypatch):
    """also lines that come twice, without a key, or equal under the keys of orders that are not there."""
    for t in ("part", "customer", "nation", "region"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    li, od = (tables.read_table(spark, SF_SMALL, t) for t in ("lineitem", "orders"))
    k = F.col("l_orderkey")
    some = li.where(k < 300)
    far = some.where(k % 5 == 1)
    li = some.union(some.where(k % 3 == 0)).union(some.where(k % 7 == 0).withColumn("l_orderkey", F.lit(None).cast("long")))
    for i in (0, 1):  # far from the orders, and where the defects of the keys are the same
        li = li.union(far.withColumn("l_orderkey", k + 50 * 33 * 14 * 25 * 3001 * (4001 + i)).withColumn("l_linenumber", F.lit(20)))
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    od.where("o_orderkey % 11 != 2").union(od.where("o_orderkey % 13 = 3")).write.parquet(str(tmp_path / "orders.parquet"))
    raw = tables.sales_raw(spark, str(tmp_path))
    whole = C.clean_sales(raw)
    monkeypatch.setattr(tables, "SHARE_BYTES", 1)
    shares = tables.raw_shares(spark, str(tmp_path))
    assert len(shares) == tables.SHARES
    apart = C.count_copies(C.nan_to_null(shares[0].unionByName(shares[1]).unionByName(shares[2]).unionByName(shares[3])), tables.LINE_ORDER)
    assert apart.count() > whole.clean.count()  # some lines without an order are copies under another key
    got = C.clean_sales(raw, shares=shares, near=tables.LINE_ORDER)
    assert got.clean.schema == whole.clean.schema
    assert got.clean.exceptAll(whole.clean).count() == 0 and whole.clean.exceptAll(got.clean).count() == 0
    for part in ("report", "issues", "validation"):
        assert sorted(map(str, getattr(got, part).collect())) == sorted(map(str, getattr(whole, part).collect()))


def test_shuffle_files_go_with_each_share(spark):
    """the disk holds the shuffle files of one share, not those of all until the driver collects its garbage."""
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    frames = [spark.range(i, 4000, 3).repartition(3, F.col("id") % 7).groupBy((F.col("id") % 50).alias("k")).count() for i in range(3)]
    got = materialize_each(frames)
    for _ in range(50):  # Spark removes them behind the query
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert got.count() == 150 and got.agg(F.sum("count")).first()[0] == 4000
    assert materialize_each(frames, "none").exceptAll(got).count() == 0
