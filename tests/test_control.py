"""Parallel commits to the control table, and checks observed by the pass that writes."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scorelake.operators import quality
from scorelake.sources import control, ingest, layers, sinks
from scorelake.sources.tables import TableSpec

from .test_history import at

SPEC = TableSpec("T", "t", "incremental", "scd2", ("k",), ("ts",), "ts")


def run(spark, table, day, n=1, status="SUCCESS", run_id="r"):
    return spark.createDataFrame([(table, "bronze", at(day), status, at(day), n, run_id)], ingest.CONTROL)


def test_nine_parallel_writers_lose_no_row(spark, tmp_path):
    path, errors, done = str(tmp_path / "control"), [], []
    start = threading.Barrier(9)

    def write(i):
        try:
            start.wait()
            done.append(control.commit(spark, path, run(spark, f"t{i}", i % 5), attempts=60, base_delay=0.01))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sorted(done) == list(range(9)) == control.versions(spark, path)
    assert {r.table_name: r.last_processed_watermark for r in control.read(spark, path).collect()} == {f"t{i}": at(i % 5) for i in range(9)}
    assert control.read(spark, path, 0).count() == 1
    assert control.vacuum(spark, path, keep=2) == 7 and control.versions(spark, path) == [7, 8]


def test_a_conflict_is_applied_to_what_the_other_run_left(spark, tmp_path, monkeypatch):
    path, waits = str(tmp_path / "control"), []
    control.commit(spark, path, run(spark, "t", 1, 5))
    real, first = control.create_if_absent, [True]

    def slow(session, target, text):
        if first:
            first.clear()
            assert real(session, target, control.as_text(ingest.next_control(control.read(session, path, 0), run(session, "t", 4, 7))))
        return real(session, target, text)

    monkeypatch.setattr(control, "create_if_absent", slow)
    assert control.commit(spark, path, run(spark, "t", 9, 0, "FAILED"), base_delay=2, sleep=waits.append) == 2
    row = control.read(spark, path).first()
    assert (row.last_processed_watermark, row.rows_processed, row.last_run_status) == (at(4), 7, "FAILED")  # the other run's mark stays
    assert len(waits) == 1 and 2 <= waits[0] <= 4


def test_a_run_gives_up_after_its_attempts(spark, tmp_path, monkeypatch):
    waits = []
    monkeypatch.setattr(control, "create_if_absent", lambda *a: False)
    with pytest.raises(control.CommitConflict):
        control.commit(spark, str(tmp_path / "c"), run(spark, "t", 1), attempts=4, base_delay=1, sleep=waits.append)
    assert len(waits) == 3 and all(2**i <= w <= 2**i + 1 for i, w in enumerate(waits))


def test_marks_keep_their_microseconds(spark, tmp_path):
    mark = datetime(2024, 1, 1, 2, 3, 4, 567891)
    row = ("t", "bronze", mark, "SUCCESS", mark, 1, "r")
    control.commit(spark, str(tmp_path / "c"), spark.createDataFrame([row], ingest.CONTROL))
    assert tuple(control.read(spark, str(tmp_path / "c")).first()) == row


def test_create_if_absent(spark, tmp_path):
    assert control.create_if_absent(spark, f"{tmp_path}/a/x", "one")
    assert not control.create_if_absent(spark, f"file://{tmp_path}/a/x", "two")
    assert (tmp_path / "a/x").read_text() == "one"
    assert [p.name for p in (tmp_path / "a").iterdir() if p.suffix == ".tmp"] == []


def values(df):
    return {(r.check_name, r.column_name): (r.passed, r.value) for r in df.collect()}


@pytest.mark.parametrize("n", [0, 1, 500])
def test_observed_checks_equal_the_suite_over_the_files(spark, tmp_path, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 1.5).alias("x"), F.when(F.col("id") % 3 == 0, "B").otherwise("G").alias("t")).repartition(3)
    options = {"min_rows": 10, "not_null": ("x", "id", "gone"), "required": ("id", "gone"), "ranges": {"x": (0.0, 600.0)}, "target": ("t", "B", "G")}
    checks, seen = quality.checked_write(df, lambda d: sinks.overwrite(d, str(tmp_path / "out")), **options, more={"top": F.max("id")})
    written = spark.read.parquet(str(tmp_path / "out"))
    assert values(checks) == values(quality.run_checks(written, **options))
    assert seen["rows"] == written.count() == n and seen["top"] == (n - 1 if n else None)


def test_a_load_reads_its_source_once(spark, tmp_path):
    spark.range(100).selectExpr("id as k", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) as ts").write.parquet(f"{tmp_path}/source")
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    source = spark.read.parquet(f"{tmp_path}/source")
    counted = source.mapInArrow(count, source.schema)
    now = F.lit("2024-03-01").cast("timestamp_ntz")
    assert layers.load_bronze(counted, f"{tmp_path}/a", TableSpec("T", "t"), "s", "r0", now) == ("historical", 100)
    assert reads.value == 100
    kind, checks = layers.load_bronze_marked(counted, f"{tmp_path}/b", f"{tmp_path}/control", SPEC, "s", "r1", now)
    assert kind == "historical" and reads.value == 200 and all(r.passed for r in checks.collect())


def test_loads_by_the_stored_mark(spark, tmp_path):
    rows = lambda *days: spark.createDataFrame([(d, at(d)) for d in days], "k int, ts timestamp_ntz")
    load = lambda df, run_id, **o: layers.load_bronze_marked(df, f"{tmp_path}/b", f"{tmp_path}/c", SPEC, "s", run_id, F.lit("2024-03-01").cast("timestamp_ntz"), **o)
    known = lambda: sorted(r.k for r in layers.read_bronze(spark, f"{tmp_path}/b").collect())
    mark = lambda: control.read(spark, f"{tmp_path}/c").first()
    assert load(rows(1, 2, 3), "r0")[0] == "historical"
    assert load(rows(1, 2, 3, 5), "r1")[0] == "incremental" and known() == [1, 2, 3, 5] and mark().rows_processed == 1
    load(rows(1, 2, 3, 5, 8), "r2", checks={"min_rows": 2})  # fails: one new row only
    assert known() == [1, 2, 3, 5] and (mark().last_run_status, mark().last_processed_watermark) == ("FAILED", at(5))
    load(rows(3, 5, 8, 9), "r3", checks={"min_rows": 2})
    assert known() == [1, 2, 3, 5, 8, 9] and mark().last_processed_watermark == at(9)
    load(rows(9), "r4")  # nothing new
    assert known() == [1, 2, 3, 5, 8, 9] and mark().last_processed_watermark == at(9) and mark().rows_processed == 0
    assert load(rows(4, 6), "r5", force=True)[0] == "historical" and known() == [4, 6]
    assert mark().last_run_timestamp == datetime(2024, 3, 1)
