"""The registered corpus queries that SQL expresses, against DuckDB."""

import duckdb
import pytest

from tessera.llm.queries import ORACLE, QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_match(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    order = [want.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
