"""The queries that SQL can express, against DuckDB: names, types and values."""

from __future__ import annotations

import duckdb
import pytest

from clinistar.llm import queries

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema.fields} == {c: str(t) for c, t in zip(want.columns, want.types)}
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r) for r in got.select(*want.columns).collect()) == key(want.fetchall())
