"""Metrics of merged daily sketches against exact ones, and late rows of a stream."""

import os
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scorelake.operators import metrics, sketches
from scorelake.streaming import streams


def scores(spark, n=20_000, days=30):
    """Three populations, of which one has drifted, over some days; scores of the bad ones are higher."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    df = spark.range(n, numPartitions=8).select(
        (start + F.make_interval(days=(F.xxhash64("id") % days + days) % days)).alias("ts"), (F.abs(F.xxhash64("id", F.lit(1))) % 2).alias("bad"),
        F.element_at(F.array(F.lit("DEV"), F.lit("HOL"), F.lit("OOT")), (F.col("id") % 3 + 1).cast("int")).alias("g"), ((F.abs(F.xxhash64("id", F.lit(2))) % 10_000) / 10_000.0).alias("u"),
    )
    return df.withColumn("s", F.round(F.col("u") * 0.7 + 0.3 * F.col("bad") * F.col("u") + F.when(F.col("g") == "OOT", 0.15).otherwise(0.0), 3))


def test_windows_from_daily_sketches(spark, tmp_path):
    df = scores(spark).persist()
    path = str(tmp_path / "s")
    for day in range(30):  # a run a day, which reads its own day only
        d = date(2024, 1, 1) + timedelta(day)
        sketches.write_day(sketches.score_sketches(df.where(F.to_date("ts") == F.lit(str(d)).cast("date")), "ts", ["g", "bad"], "s"), path, d)
    daily = sketches.read_days(spark, path)
    for first, last in (("2024-01-01", "2024-01-30"), ("2024-01-08", "2024-01-14")):
        part = df.where(F.to_date("ts").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        window = sketches.merged(daily, ["g", "bad"], first, last)
        exact = {r.g: r for r in metrics.roc_metrics(part, "bad", "s", ["g"]).collect()}
        got = {r.g: r for r in sketches.window_roc(window, "bad", ["g"]).collect()}
        assert got.keys() == exact.keys()
        for g, r in got.items():
            assert (r.n, r.auc, r.ks) == (exact[g].n, pytest.approx(exact[g].auc, abs=0.01), pytest.approx(exact[g].ks, abs=0.015))
        whole = sketches.merged(daily, ["g"], first, last)
        psi = {r.g: (r.psi, r.alert_level) for r in metrics.psi(part, "s", "g", "DEV").collect()}
        found = {r.g: (r.psi, r.alert_level) for r in sketches.window_psi(whole, "g", "DEV").collect()}
        assert found.keys() == psi.keys() and all(found[g][0] == pytest.approx(psi[g][0], abs=0.03) for g in psi)
        assert found["OOT"][1] != "none"
        for r in sketches.window_quantiles(whole, [0.1, 0.5, 0.9]).collect():
            own = sorted(x.s for x in part.where(F.col("g") == r.g).select("s").collect())
            for share, q in zip((0.1, 0.5, 0.9), r.quantiles):
                assert own[int((share - 0.01) * len(own))] <= q <= own[int((share + 0.01) * len(own))]


def test_a_new_day_leaves_the_others_alone(spark, tmp_path):
    df = scores(spark, 500, 4)
    path, days = str(tmp_path / "s"), [date(2024, 1, d) for d in range(1, 5)]
    daily = sketches.distinct_sketches(df, "ts", ["s", "g"])
    for d in days[:3]:
        sketches.write_day(daily, path, d)
    before = {f"{a}/{n}": os.stat(f"{a}/{n}").st_mtime_ns for a, _, names in os.walk(path) for n in names}
    sketches.write_day(daily, path, days[3])
    sketches.write_day(daily, path, days[3])
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    got = {r.column_name: r for r in sketches.distinct_between(sketches.read_days(spark, path), days[0], days[3]).collect()}
    assert got["g"].estimate == 3 and got["s"].rows == 500 == got["g"].rows


def test_distinct_estimates_are_within_their_error(spark):
    df = spark.range(60_000).select(F.lit("2024-01-05").cast("timestamp_ntz").alias("ts"), (F.col("id") % 20_000).alias("a"), F.when(F.col("id") < 0, 1).alias("nothing"))
    got = {r.column_name: r.estimate for r in sketches.distinct_between(sketches.distinct_sketches(df, "ts", ["a", "nothing"]), "2024-01-05", "2024-01-05").collect()}
    assert got["nothing"] == 0 and abs(got["a"] - 20_000) <= 4 * 0.0081 * 20_000


def test_one_class_and_empty_windows(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "a", 1, 0.5), (datetime(2024, 1, 1), "b", 0, 0.5), (datetime(2024, 1, 1), "b", 1, 0.5), (datetime(2024, 1, 1), "c", 1, None)], "ts timestamp_ntz, g string, y int, s double")
    daily = sketches.score_sketches(df, "ts", ["g", "y"], "s")
    got = {r.g: (r.n, r.auc, r.ks) for r in sketches.window_roc(sketches.merged(daily, ["g", "y"], "2024-01-01", "2024-01-02"), "y", ["g"]).collect()}
    assert got == {"a": (1, None, None), "b": (2, 0.5, 0.0)}
    assert sketches.window_roc(sketches.merged(daily, ["g", "y"], "2025-01-01", "2025-01-02"), "y", ["g"]).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_closed_late_and_open_days_add_up_to_the_input(spark, tmp_path, seed):
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    data = [(start + timedelta(hours=rnd.randint(0, 24 * 12)), rnd.choice("ab"), rnd.randint(0, 9) / 2) for _ in range(300)]
    data.sort(key=lambda r: r[0] + timedelta(hours=rnd.choice([0, 10, 200])))  # some rows come days late
    schema = "ts timestamp, event_type string, value double"
    state, late_days = str(tmp_path / "state"), 0
    for i in range(0, 300, 60):
        batch = data[i : i + 60] + ([(None, "a", 1.0)] if i == 120 else [])
        spark.createDataFrame(batch, schema).write.mode("append").parquet(str(tmp_path / "in"))
        streams.profile_with_late(streams.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), state, str(tmp_path / "checkpoint"), "ts")
        closed, late, opened = streams.profile_parts(spark, state)
        want = {}
        for t, e, v in data[: i + 60] + ([(None, "a", 1.0)] if i >= 120 else []):
            n, total = want.get((t and t.date(), e), (0, 0.0))
            want[t and t.date(), e] = n + 1, total + v
        parts = closed.unionByName(opened).unionByName(late.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")))
        got = {(r.day, r.event_type): (r.n, r.total) for r in parts.groupBy("day", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
        assert got == want
        days = [r.day for r in closed.select("day").distinct().collect()]
        assert not days or max(days) < max(t for t, *_ in data[: i + 60]).date() - timedelta(1)
        assert closed.count() == closed.select("day", "event_type").distinct().count()  # a day closes once
        late_days = late.count()
    assert late_days > 1 and days
