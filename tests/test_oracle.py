"""Every query with SQL gives the rows that DuckDB gives."""

import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from scorelake.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in os.listdir(FOLDER):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{FOLDER}/{t}'")
    return c


def plain(x):
    if isinstance(x, datetime) and (x.hour, x.minute, x.second, x.microsecond) == (0, 0, 0, 0):
        x = x.date()
    if isinstance(x, (Decimal, float)):
        x = round(float(x), 5)
    return x.isoformat() if isinstance(x, (date, datetime)) else x


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=2e-4) if all(isinstance(x, (int, float)) for x in g) else g == w


def test_queries_without_sql_give_rows(spark):
    for name in sorted(set(QUERIES) - set(ORACLE_SQL)):
        assert QUERIES[name](spark, FOLDER).count() > 0
