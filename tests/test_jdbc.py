"""Database scans against the Derby that comes with Spark, in memory."""

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scorelake.sources import tables

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture
def database(spark):
    """Writes rows as a table of a database of its own; its url."""

    def write(df, table="T"):
        url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
        df.write.jdbc(url, table, properties=DRIVER)
        return url

    return write


def skewed(spark, n=4000):
    rnd = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = [(None if rnd.random() < 0.1 else int(rnd.expovariate(1) ** 4 * 1000), i, start + timedelta(minutes=rnd.expovariate(1) ** 3 * 5000), date(2024, 1, 1) + timedelta(int(rnd.expovariate(1) ** 2 * 50)), rnd.random() ** 5) for i in range(n)]
    return spark.createDataFrame(rows, "K long, V int, TS timestamp, D date, X double")


def sizes(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().collect()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("column", ["K", "TS", "D", "X"])
@pytest.mark.parametrize("slices", [1, 5])
def test_slices_of_a_skewed_column_are_about_equal_and_whole(spark, database, column, slices):
    df = skewed(spark)
    url = database(df)
    got = tables.read_jdbc_slices(spark, url, "T", DRIVER, column, slices)
    assert rows(got) == rows(df)
    filled = df.where(F.col(column).isNotNull()).count()
    own = [r["count"] for r in sizes(got.where(F.col(column).isNotNull()))]
    assert len(own) >= slices and max(own) <= 2 * filled / slices + 60  # days repeat
    if slices == 5 and column == "K":  # equal ranges would put nearly all rows into one
        even = tables.read_jdbc(spark, url, "T", DRIVER, "K", "0", str(df.agg(F.max("K")).first()[0]), 5)
        assert max(r["count"] for r in sizes(even)) > 4 * filled / 5


def test_a_heavy_value_and_nulls_have_slices_of_their_own(spark, database):
    df = spark.createDataFrame([(7, i) for i in range(600)] + [(None, i) for i in range(300)] + [(i % 100, i) for i in range(900)], "K int, V int")
    got = tables.read_jdbc_slices(spark, database(df), "T", DRIVER, "K", 6)
    assert rows(got) == rows(df)
    by_part = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("K").alias("keys"), F.count("*").alias("n"), F.max("K").alias("k")).collect()
    assert (1, 609, 7) in {(r["keys"], r["n"], r["k"]) for r in by_part}
    assert (0, 300, None) in {(r["keys"], r["n"], r["k"]) for r in by_part}


@pytest.mark.parametrize("data", [[], [(None, 1), (None, 2)], [(3, 1)]])
def test_small_tables(spark, database, data):
    df = spark.createDataFrame(data, "K int, V int")
    assert rows(tables.read_jdbc_slices(spark, database(df), "T", DRIVER, "K", 4)) == rows(df)


def test_filters_and_columns_reach_the_database(spark, database):
    url = database(skewed(spark))
    plan = tables.read_jdbc_slices(spark, url, "T", DRIVER, "K", 4, "MOD(V, 10) = 0").where("V > 3990").select("V")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "GreaterThan(V,3990)" in text and "ReadSchema: struct<V:int>" in text
    assert sorted(r.V for r in plan.collect()) == list(range(3991, 4000))


def test_equals_the_parquet_table(spark, database):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    url = database(orders, "ORDERS")
    key = '"o_totalprice"'
    assert rows(tables.read_jdbc_slices(spark, url, "ORDERS", DRIVER, key, 8)) == rows(orders)


def test_every_row_is_in_one_slice():
    clauses = tables.slice_predicates("k", [2, 5], [3])
    assert clauses == ["k < 2 AND k <> 3", "k >= 2 AND k < 5 AND k <> 3", "k >= 5 AND k <> 3", "k = 3", "k IS NULL"]
    assert tables.slice_predicates("k", [], []) == ["k IS NOT NULL", "k IS NULL"]
