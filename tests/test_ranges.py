"""Two-level forms give what one window a group gives; samples by level; the mart's grain."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from scorelake.operators import metrics, ranges, scd2, split, woe
from scorelake.plans import mart

from .test_history import table


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limit", [3, 17, 10_000])
@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_running_sums_do_not_depend_on_ranges(spark, limit, by):
    rnd = random.Random(limit)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.randint(0, 2), i, rnd.random() if i % 9 else None, rnd.randint(-5, 5)) for i in range(200)]
    df = spark.createDataFrame(data, "g string, h int, k int, s double, x long")
    got = ranges.running_sums(df, by, ["s", "k"], ["x"], rows_per_range=limit)
    group = by or [F.lit(0)]
    upto = Window.partitionBy(*group).orderBy("s", "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"_upto_x": F.sum("x").over(upto), "_all_x": F.sum("x").over(Window.partitionBy(*group))})
    assert rows(got.select(*want.columns)) == rows(want)


def test_metrics_do_not_depend_on_ranges(spark, monkeypatch):
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.randint(0, 1), round(rnd.random(), 2), rnd.choice("xyz"), rnd.choice([1, 2, None])) for _ in range(500)], "y int, s double, g string, m int")
    long = woe.long_form(df.withColumn("t", F.col("s") * F.col("s")), ["s", "t"], "y", "double")
    take = lambda: (rows(metrics.roc_metrics(df, "y", "s", ["g"])), rows(metrics.roc_metrics(df, "y", "s")), rows(metrics.weighted_gini(df, "y", "s", "m")), [(f, [round(x, 9) for x in p]) for f, p in rows(woe.quantiles(long, [0, 0.1, 0.77, 1.0]))])
    want = take()
    points = metrics.score_points(df, "y", "s", ["g", "m"])
    assert rows(metrics.point_metrics(points, ["g"])) == want[0] and rows(metrics.point_metrics(points)) == want[1]
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 9)
    monkeypatch.setattr(metrics, "ROWS_PER_RANGE", 9)
    assert take() == want
    assert rows(metrics.point_metrics(points, ["g"])) == want[0]


def test_counted_evidence_equals_that_of_rows(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.choice([None, *[float(i) for i in range(30)]]), 3.0, rnd.choice("aaaabbbcd") + ("" if rnd.random() < 0.9 else str(rnd.randint(0, 30))), rnd.choice([0, 1, None])) for _ in range(900)], "x double, one double, l string, y int")
    close = lambda found: [tuple(pytest.approx(v) if isinstance(v, float) else v for v in r) for r in rows(found)]
    by_rows = woe.evidence(woe.continuous_bands(df, ["x", "one"], "y"), "band")
    assert rows(woe.continuous_evidence(df, ["x", "one"], "y").select(*by_rows.columns)) == close(by_rows)
    long = woe.long_form(df, ["l"], "y", "string")
    by_rows = woe.evidence(woe.group_rare(long), "level")
    assert rows(woe.categorical_evidence(long).select(*by_rows.columns)) == close(by_rows)


@pytest.mark.parametrize("limit", [1, 4, 1000])
def test_a_hot_key_over_many_ranges_has_the_versions_of_one_window(spark, limit):
    rnd = random.Random(limit)
    log = [(7, rnd.choice("ab"), rnd.randint(0, 25)) for _ in range(60)] + [(k, rnd.choice("abc"), rnd.randint(0, 25)) for k in (1, 2, 8, 9, None) for _ in range(6)] + [(3, "a", d) for d in range(20)]
    df = table(spark, log).repartition(5)
    want = scd2.from_log(df, ["k", "g"], "ts")
    got = scd2.from_log(df, ["k", "g"], "ts", rows_per_range=limit)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(scd2.from_log(df.limit(0), ["k", "g"], "ts", rows_per_range=limit)) == []


def test_large_tables_are_looked_at_for_hot_keys(spark, monkeypatch):
    df = table(spark, [(k, "ab"[d % 2], d) for k in (1, 2) for d in range(10)])
    want = rows(scd2.from_log(df, ["k", "g"], "ts"))
    monkeypatch.setattr(scd2, "SMALL_BYTES", -1)
    assert rows(scd2.from_log(df, ["k", "g"], "ts")) == want
    monkeypatch.setattr(scd2, "HOT_ROWS", 4)
    assert rows(scd2.from_log(df, ["k", "g"], "ts")) == want


def levels(spark):
    return spark.createDataFrame([(i, "abbbccccc"[i % 9] if i % 50 else None) for i in range(3000)], "k int, l string")


def test_rates_of_levels(spark):
    df = levels(spark)
    got = split.sample_levels(df, "k", "l", {"a": 1.0, "b": 0.5, None: 0.0}, default=0.1)
    assert rows(got) == rows(split.sample_levels(df.repartition(7), "k", "l", {"a": 1.0, "b": 0.5, None: 0.0}, default=0.1))
    all_of, n = ({r.l: r["count"] for r in d.groupBy("l").count().collect()} for d in (df, got))
    assert n["a"] == all_of["a"] and None not in n and abs(n["b"] / all_of["b"] - 0.5) < 0.07 and abs(n["c"] / all_of["c"] - 0.1) < 0.05
    assert split.sample_levels(df, "k", "l", {}).count() == 0
    shares = split.populations(df.withColumn("d", F.lit("2024-01-01")), "k", "d", F.lit(True), F.lit("2024-06-01"), 0.2, level="l", rates={"a": 1.0}).groupBy("l", "_population").count().collect()
    assert {r.l for r in shares if r._population == "HOL"} == {"b", "c", None}


@pytest.mark.parametrize("slices", [1, 5, 4096])
def test_quotas_of_levels_are_exact(spark, slices):
    df = levels(spark)
    quotas = {"a": 100, "b": 100_000, "c": 7, None: 3, "unseen": 5, "a ": 0}
    got = rows(split.sample_quota(df, "k", "l", quotas, slices=slices))
    nth = F.row_number().over(Window.partitionBy("l").orderBy(split.bucket(F.col("k"), 42), "k"))
    quota = F.create_map(*[x for k, v in quotas.items() if k is not None for x in (F.lit(k), F.lit(v))])
    want = df.withColumn("nth", nth).where(F.col("nth") <= F.coalesce(quota[F.col("l")], F.when(F.col("l").isNull(), 3), F.lit(0))).drop("nth")
    assert got == rows(want)
    assert rows(split.sample_quota(df, "k", "l", {}, slices=slices)) == []


def test_the_mart_tells_when_its_grain_is_lost(spark, tmp_path):
    fact = spark.createDataFrame([(1, "d1", "APPROVED", "2024-01-05"), (2, "d1", "DECLINED", "2024-01-05"), (3, None, "APPROVED", None)], "a int, d string, decision string, day string")
    dim = spark.createDataFrame([("d1", "x")], "d string, name string")
    bridge = spark.createDataFrame([(1, "f1"), (3, "f2")], "a int, f string")
    facility = spark.createDataFrame([("f1", 10.0), ("f2", 20.0)], "f string, amount double")
    performance = spark.createDataFrame([("f1", 95, 0, 3, "2024-03-01")], "f string, max_arrears_days_24mo int, hardship_ever_24mo int, perf_observations long, last_observed_date string")
    build = lambda d, b: mart.full_mart(fact, [(d, ["d"])], b, facility, performance, "a", "f", "decision", "day")
    assert tuple(mart.write_mart(build(dim, bridge), fact, str(tmp_path / "m")).first()) == (3, 3, True)
    got = {r.a: (r.name, r.amount, r.target_flag, r.sample_flag) for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert got == {1: ("x", 10.0, "Bad", "Funded"), 2: ("x", None, "Rejected", "NotFunded"), 3: (None, 20.0, "NotFunded", "Funded")}
    twice = dim.union(dim)
    assert tuple(mart.write_mart(build(twice, bridge), fact, str(tmp_path / "m")).first()) == (3, 5, False)
    assert not mart.write_mart(build(dim, bridge.union(bridge)), fact, str(tmp_path / "m")).first().matches


def test_applications_without_a_facility_stay_in_many_tasks(spark):
    """They have no facility key; by that key all of them would be sorted by one task."""
    ids = spark.range(4000).select(F.col("id").alias("a"), F.lit("d1").alias("d"), F.when(F.col("id") % 10 == 0, "APPROVED").otherwise("DECLINED").alias("decision"), F.lit("2024-01-05").alias("day"))
    fact = ids.unionByName(ids.limit(1).withColumn("a", F.lit(None).cast("long")))
    dim = spark.createDataFrame([("d1", "x")], "d string, name string")
    facility = spark.range(0, 3000, 20).select((F.col("id") % 1000).cast("string").alias("f"), F.col("id").cast("double").alias("amount")).dropDuplicates(["f"])
    performance = spark.range(0, 3000, 30).select(F.col("id").cast("string").alias("f"), (F.col("id") % 120).cast("int").alias("max_arrears_days_24mo"), F.lit(0).alias("hardship_ever_24mo"), F.lit(3).alias("perf_observations"), F.lit("2024-03-01").alias("last_observed_date"))
    bridge = ids.where("decision = 'APPROVED'").select("a", F.when(F.col("a") % 70 != 0, F.col("a").cast("string")).alias("f"), F.lit("2024-02-01").alias("funded"))
    bridge = bridge.union(bridge.where("a % 300 = 0"))  # two rows an application
    hold = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in hold}
    try:
        for k, v in hold.items():
            spark.conf.set(k, v)
        got = mart.full_mart(fact, [(dim, ["d"])], bridge, facility, performance, "a", "f", "decision", "day")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    plain = fact.join(dim, "d", "left").join(bridge, "a", "left").join(facility, "f", "left").join(performance, "f", "left")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    columns = ["a", "name", "funded", "amount", "max_arrears_days_24mo", "perf_observations", "last_observed_date"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(map(tuple, plain.select(columns).collect()), key=repr)
