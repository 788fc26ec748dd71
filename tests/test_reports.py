"""Sources and sinks: quarantine of malformed rows, report sets, counters of retried tasks, saved models."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from tessera.operators import clean as C
from tessera.operators import marts
from tessera.sources import files as FI
from tessera.sources import sales

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_quarantine_splits_rows_by_fault(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("day", T.DateType()),
                           T.StructField("x", T.DoubleType()), T.StructField("ok", T.BooleanType()), T.StructField("s", T.StringType())])
    lines = ["id,day,x,ok,s", "1,2024-02-29,1.5,true,plain", '2,2024-01-01,1e3,false,"a, b"', "3,,,,", ",2024-01-01,1,true,no id",
             "4,2023-02-29,x,maybe,three faults", "5,2024-01-01,1,true", "6,2024-01-01,1,true,s,extra", "7.5,2024-01-01, 2 ,true,é"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    good, bad = FI.read_quarantined(spark, str(tmp_path / "a.csv"), schema)
    assert good.schema.simpleString() == schema.simpleString()
    assert sorted((r.id, str(r.day), r.x, r.ok, r.s) for r in good.collect()) == [
        (1, "2024-02-29", 1.5, True, "plain"), (2, "2024-01-01", 1000.0, False, "a, b"), (3, "None", None, None, None)]
    got = {r.line: [(f.field, f.reason) for f in r.reasons] for r in bad.collect()}
    assert sorted(got.values(), key=str) == sorted(
        [[("id", "missing")], [("day", "type"), ("x", "type"), ("ok", "type")], [(None, "columns")], [(None, "columns")], [("id", "type")]], key=str)
    assert {"5,2024-01-01,1,true", "6,2024-01-01,1,true,s,extra"} <= set(got)  # the raw line where the width is wrong


def test_report_set_is_published_whole_or_not_at_all(spark, tmp_path):
    base = str(tmp_path / "reports")
    assert FI.read_reports(spark, base) == {} and FI.check_reports(spark, base).collect() == []
    a, b = spark.range(5).toDF("x"), spark.createDataFrame([("é", None), (None, 2.5)], "k string, v double")
    FI.write_reports({"a": a, "b": b}, base)
    assert sorted(map(tuple, FI.check_reports(spark, base).collect())) == [("a", 5, True), ("b", 2, True)]
    bad = spark.range(3).select(F.raise_error(F.lit("stopped")).cast("long").alias("x"))
    with pytest.raises(Exception, match="stopped"):
        FI.write_reports({"a": spark.range(99).toDF("x"), "b": bad}, base)  # the second table fails
    now = FI.read_reports(spark, base)
    assert now["a"].count() == 5 and sorted(now["b"].collect(), key=str) == sorted(b.collect(), key=str)
    FI.write_reports({"a": spark.range(7).toDF("x")}, base)
    assert {n: d.count() for n, d in FI.read_reports(spark, base).items()} == {"a": 7}
    # a file that goes missing is noticed
    part = FI.read_manifest(spark, base)["a"]["path"]
    files = [f for f in os.listdir(os.path.join(base, part)) if f.endswith(".parquet")]
    os.remove(os.path.join(base, part, max(files, key=lambda f: os.path.getsize(os.path.join(base, part, f)))))
    assert FI.check_reports(spark, base).first().intact is False


RETRY = """
import json, sys
from pyspark.sql import SparkSession, functions as F
from pyspark import TaskContext
s = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
s.sparkContext.setLogLevel("OFF")
from tessera.operators.clean import counted
def flaky(batches):
    for b in batches:
        yield b
    if TaskContext.get().attemptNumber() < 2 and TaskContext.get().partitionId() != 1:
        raise RuntimeError("lost")
df = s.range(0, 1000, 1, 4).mapInPandas(flaky, "id long")
out, seen = counted(df, {"rows": F.count(F.lit(1)), "total": F.sum("id")})
got = seen()
print("RESULT", json.dumps([got["rows"], got["total"], out.count()]))
"""


def test_counters_of_retried_tasks_count_once():
    """Three of four writing tasks fail twice after they have passed on all their rows."""
    env = {**os.environ, "PYTHONPATH": REPO}
    p = subprocess.run([sys.executable, "-c", RETRY], capture_output=True, text=True, env=env, timeout=300)
    line = next(x for x in p.stdout.splitlines() if x.startswith("RESULT"))
    assert json.loads(line[7:]) == [1000, 499500, 1000]


def test_report_needs_no_scan_after_the_writes(spark):
    raw = spark.createDataFrame([(float(i % 50 + 18), " m " if i % 3 else "F", i - 2, 10.0 + i % 7, 0.1, f"2024-01-{i % 28 + 1:02d}", 4.0, 1.0)
                                 for i in range(200)], "age double, gender string, quantity int, unit_price double, discount double, "
                                                       "order_date string, customer_rating double, shipping_days double")
    res = C.clean_sales(raw)
    rows = res.report.collect(), res.issues.collect(), res.validation.collect()
    assert rows[0][0].raw_rows == 200 and rows[0][0].final_rows == res.clean.count() and len(rows[2]) == 6
    for df in (res.report, res.issues, res.validation):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Exchange" not in plan
    assert rows[0][0].negative_qty_fixed == 2


def test_modes_of_a_large_domain_and_ties(spark):
    big = spark.range(1_000_000).select(F.col("id").cast("string").alias("a"), F.when(F.col("id") % 2 == 0, "x").otherwise("b").alias("b"),
                                        F.lit(None).cast("string").alias("c"), (F.col("id") % 7).alias("d"))
    more = big.unionByName(spark.createDataFrame([("5", None, None, None), ("31", None, None, None)], "a string, b string, c string, d long"))
    assert C.modes(more, ["a", "b", "c", "d"]) == {"a": "31", "b": "b", "c": None, "d": 0}
    assert C.modes(more.limit(0), ["a"]) == {"a": None} and C.modes(more, []) == {}


def test_customer_sketches_unite_within_their_bound(spark):
    rows = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(30_000))).alias("customer_id"), F.element_at(F.array(
        *map(F.lit, ["n", "s", "e"])), (F.col("id") % 3).cast("int") + 1).alias("region"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("order_date"))
    stored = marts.customer_sketches(rows)
    assert stored.count() == 36
    for by, n in (((), 1), (("group",), 3), (("month",), 12), (("month", "group"), 36)):
        got = marts.estimate_customers(stored, by).collect()
        assert len(got) == n
    exact = rows.agg(F.count_distinct("customer_id")).first()[0]
    assert abs(marts.estimate_customers(stored).first()[0] - exact) <= marts.sketch_error() * exact
    out = marts.distinct_customers(rows)
    assert out.where("NOT within").count() == 0 and out.count() == 52
    # a later month is united with the stored ones: nobody is counted twice
    again = stored.unionByName(marts.customer_sketches(rows.where("region = 'n'")))
    assert marts.estimate_customers(again).first()[0] == pytest.approx(exact, rel=marts.sketch_error())
    assert [tuple(r) for r in marts.distinct_customers(rows.limit(0)).collect()] == [("all", None, None, 0, True)]
    assert marts.distinct_customers(sales(spark, SF_SMALL)).where("NOT within").count() == 0


def test_saved_trees_score_like_the_model(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    from tessera.operators import forecast as FC
    df = spark.range(600).select((F.col("id") % 17).cast("double").alias("a"), F.rand(1).alias("b"), F.rand(2).alias("c")) \
        .withColumn("total_sales", F.col("a") * 3 + F.sin(F.col("b") * 9) + F.col("c"))
    rf = RandomForestRegressor(featuresCol="features", labelCol="total_sales", numTrees=7, maxDepth=6, seed=3)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), rf]).fit(df)
    fc = FC.Forecaster(model, ["a", "b", "c"], df, df, df, FC.ForecastParams())
    path = FC.save_model(fc, str(tmp_path / "m"))
    both = FC.score_saved(model.transform(df), path, out="again")
    assert both.where("abs(again - prediction) > 1e-9").count() == 0 and both.count() == 600
    assert "Python" not in both._jdf.queryExecution().executedPlan().toString()
