"""Queries of this subpackage that SQL expresses, on the smallest tables."""

import duckdb
import pytest

from siltwork.llm import registry


@pytest.mark.parametrize("name", ["op12_license_scan", "op13_tiered_search"])
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df, rel = registry.queries()[name](spark, sf), con.sql(registry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    assert got == sorted(repr([row[rel.columns.index(c)] for c in columns]) for row in rel.fetchall()) and got
