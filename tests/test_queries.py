"""Every registered query runs on the smallest tables; SQL-checkable ones match
the DuckDB oracle (the driver's correctness gate, at sf0.001)."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

SLOW = {"rf_eval", "rf_metrics", "ts_cv", "importance", "forecast_daily", "forecast_monthly", "timeline",
        "forecast_band"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents"]:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["region", "revenue", "orders", "avg_rating"]


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n not in SLOW and not n.startswith("op")))
def test_oracle_match(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = duck.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    assert _rows(sdf.columns, sdf.collect()) == _rows(res.columns, res.fetchall())


NO_ORACLE = {"shapiro_sample", "rf_eval", "rf_metrics", "ts_cv", "cv_summary", "importance", "forecast_daily", "forecast_monthly",
             "timeline", "forecast_band", "forecast_by_region", "strict_features"}


def test_every_query_has_oracle_or_is_listed():
    no_oracle = {n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith("op") and n != "pipeline"}
    assert no_oracle == NO_ORACLE


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_queries_without_an_oracle_run(spark, name):
    """Fitted models have no SQL; the queries run over the whole tables all the same."""
    got = entry.queries()[name](spark, SF_SMALL).collect()
    assert got and all(v is not None for v in got[0])
    if name == "forecast_by_region":
        by = {}
        for r in got:
            by.setdefault(r.region, []).append(r.order_date)
        assert len(by) == 5 and all(len(set(d)) == len(d) == 90 for d in by.values())
