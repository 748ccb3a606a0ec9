"""Every training-data query with SQL gives the rows that DuckDB gives, on the given tables and on odd rows."""

import duckdb
import pytest

from scorelake.llm._spark import ARROW_BYTES
from scorelake.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "labels")


@pytest.fixture
def small_batches(spark):
    """Python batches of some ten documents, so that blocks, ranges and runs go over several."""
    spark.conf.set(ARROW_BYTES, "20000")
    yield
    spark.conf.unset(ARROW_BYTES)


def same_rows(spark, folder, name):
    duck = duckdb.connect()
    for t in TABLES:
        source = f"{folder}/{t}.parquet" + ("" if folder == FOLDER else "/*.parquet")
        duck.execute(f"create view {t} as select * from '{source}'")
    found = QUERIES[name](spark, folder)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(found.columns)
    want = sorted((tuple(r[names.index(c)] for c in found.columns) for r in result.fetchall()), key=repr)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    return len(want)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, small_batches, name):
    assert same_rows(spark, FOLDER, name)


@pytest.mark.parametrize("rows", [[(1, "b"), (None, "a"), (1, "b"), (1, None), (7, ""), (7, "é" * 3000), (2, "x" * 70), (9, "中文 text")], [(5, "one")]])
def test_sharding_of_odd_rows_equals_sql(spark, tmp_path, rows):
    for t in TABLES:
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/{t}.parquet")
    assert same_rows(spark, str(tmp_path), "op5_sharding") == len(rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_do_not_depend_on_batches(spark, name):
    rows = []
    for size in (None, "20000"):
        if size:
            spark.conf.set(ARROW_BYTES, size)
        try:
            rows.append(sorted((tuple(r) for r in QUERIES[name](spark, FOLDER).collect()), key=repr))
        finally:
            spark.conf.unset(ARROW_BYTES)
    assert rows[0] == rows[1] and rows[0]
