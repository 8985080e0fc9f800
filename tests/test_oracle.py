"""Every registered query against its DuckDB oracle at sf0.001, compared
like the driver: column names, row count and the order-insensitive bag of
values."""

from __future__ import annotations

import collections
import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from clinistar import registry
from conftest import SF0001

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = registry.queries()
SQL = registry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert QUERIES.keys() <= entry.queries().keys() and SQL.items() <= entry.oracle_sql().items()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["DiagnosisName", "ICD10Code", "DiagnosisYear", "DiagnosisCount",
                          "PreviousYearCount", "YoYChangePercentage"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    cols = df.columns
    got = collections.Counter(tuple(_norm(v) for v in r) for r in df.collect())
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = collections.Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    ours = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    rel = duck.sql(SQL[name])
    theirs = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert ours == theirs
