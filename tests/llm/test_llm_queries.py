"""The queries that SQL can express, against DuckDB over the same whole tables."""

import duckdb
import pytest

from tidevault.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name, sf):
    path = f"/root/testdata/{sf}"
    base = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
    want = base.sql(ORACLES[name])
    got = QUERIES[name](spark, path)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = want.select(", ".join(columns)).fetchall()
    assert rows and sorted(rows) == sorted(map(tuple, got.select(columns).collect()))
