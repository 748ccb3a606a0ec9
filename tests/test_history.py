from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorelake.operators import scd2, standardize
from scorelake.sources import ingest, sinks
from scorelake.sources.tables import TableSpec, current_view, find_spec, read_specs
from scorelake.streaming.streams import merge_log

SCHEMA = "k int, g string, v string, ts timestamp_ntz"


def now():
    return F.lit("2024-03-01").cast("timestamp_ntz")


def at(day):
    return datetime(2024, 1, 1 + day)


def table(spark, rows):
    return spark.createDataFrame([(k, "g", v, at(d) if d is not None else None) for k, v, d in rows], SCHEMA)


def ready(df):
    return scd2.versioned(df, ["k", "g"], "ts", [F.desc_nulls_last("ts"), F.col("v")], now()).drop("ts")


def rows(df):
    return sorted((r.k, r.v, r._is_current, r._effective_from, r._effective_to) for r in df.collect())


def test_ten_keys_five_changes(spark):
    base = ready(table(spark, [(k, "old", 0) for k in range(10)]))
    batch = ready(table(spark, [(k, "new" if k < 5 else "old", 5) for k in range(10)]))
    after = scd2.apply(base, batch, ["k", "g"], now())
    assert tuple(scd2.summary(after).first()) == (10, 5, 15)
    assert rows(scd2.apply(after, batch, ["k", "g"], now())) == rows(after)
    closed = [r for r in rows(after) if not r[2]]
    assert {r[4] for r in closed} == {at(5)}
    processing = scd2.apply(base, batch, ["k", "g"], now(), "processing")
    assert {r[4] for r in rows(processing) if not r[2]} == {datetime(2024, 3, 1)}
    assert scd2.as_of(after, F.lit(at(5)).cast("timestamp_ntz")).count() == 10
    assert scd2.as_of(after, F.lit(at(3)).cast("timestamp_ntz")).where("v = 'old'").count() == 10


def test_new_late_deleted_and_null_start(spark):
    base = ready(table(spark, [(1, "a", 3), (2, "b", 3)]))
    batch = ready(table(spark, [(1, "late", 1), (2, "gone", 5), (3, "c", None), (4, "gone", 5), (5, "x", 1), (5, "y", 2)]))
    after = scd2.apply(base, batch, ["k", "g"], now(), delete_when=F.col("v") == "gone")
    assert rows(after) == [
        (1, "a", True, at(3), None), (2, "b", False, at(3), at(5)), (3, "c", True, datetime(2024, 3, 1), None), (5, "y", True, at(2), None),
    ]
    assert rows(scd2.apply(None, batch, ["k", "g"], now(), delete_when=F.col("v") == "gone")) == [
        (1, "late", True, at(1), None), (3, "c", True, datetime(2024, 3, 1), None), (5, "y", True, at(2), None),
    ]


def test_hash_sees_nulls_and_exact_names(spark):
    df = spark.createDataFrame([(1, None, "s"), (1, "NULL", "s"), (1, "", "s")], "id int, income_source string, _source string")
    hashes = [r[0] for r in df.select(scd2.row_hash(df, ("_source",))).collect()]
    assert len(set(hashes)) == 3
    flipped = df.select("_source", "income_source", "id")
    assert hashes == [r[0] for r in flipped.select(scd2.row_hash(flipped, ("_source",))).collect()]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab"), st.integers(0, 25)), min_size=1, max_size=20, unique_by=lambda x: (x[0], x[2])), st.integers(1, 24))
def test_intervals_are_disjoint_and_streaming_equals_batch(spark, log, cut):
    df = table(spark, log)
    whole = scd2.from_log(df, ["k", "g"], "ts")
    by_key = {}
    for k, _, current, start, end in rows(whole):
        by_key.setdefault(k, []).append((start, end, current))
    for versions in by_key.values():
        versions.sort()
        assert [v[1] for v in versions] == [*[v[0] for v in versions[1:]], None]
        assert [v[2] for v in versions].count(True) == 1
    split = F.lit(at(cut)).cast("timestamp_ntz")
    first, second = df.where(F.col("ts") < split), df.where(F.col("ts") >= split)
    merged = merge_log(scd2.from_log(first, ["k", "g"], "ts"), scd2.from_log(second, ["k", "g"], "ts"), ["k", "g"])
    assert rows(merged) == rows(whole)


def test_control_table_keeps_the_last_good_mark(spark):
    run = lambda table, mark, status, n: spark.createDataFrame([(table, "bronze", mark, status, at(9), n, "r")], ingest.CONTROL)
    control = ingest.next_control(ingest.empty_control(spark), run("t", at(1), "FAILED", 0))
    assert control.count() == 0 and ingest.last_watermark(control, "t", "bronze") is None
    control = ingest.next_control(control, run("t", at(1), "SUCCESS", 5))
    control = ingest.next_control(control, run("t", at(7), "FAILED", 0))
    row = control.first()
    assert (row.last_processed_watermark, row.last_run_status, row.rows_processed) == (at(1), "FAILED", 5)
    wanted = spark.createDataFrame([("t",), ("none",), ("t",)], "table_name string")
    assert sorted(map(tuple, ingest.last_watermarks(control, wanted, "bronze").collect())) == [("none", None), ("t", at(1))]
    assert [r.mark for r in ingest.last_watermarks(control, wanted.limit(1), "silver").collect()] == [None]
    assert ingest.choose_load("incremental", "ts", True, None) == "historical"
    source = table(spark, [(1, "a", 1), (2, "b", 2)])
    assert ingest.incremental_batch(source, source.limit(0), "ts")[1] == "historical"
    batch, kind = ingest.incremental_batch(source, source, "ts")
    assert kind == "incremental" and batch.count() == 0


def test_specs_and_names(spark, tmp_path):
    path = tmp_path / "inventory.csv"
    path.write_text("source_table,target_table,load_type,strategy,primary_key,order_by,is_active\nDIM_A,a,incremental,SCD2,\"ID, Part\",UPDATED,\nOLD,o,full,,,,false\n")
    specs = read_specs(spark, str(path))
    spec = find_spec(specs, "dim_a")
    assert spec.keys == ("id", "part") and spec.active
    spec.validate(["id", "part", "updated"])
    with pytest.raises(ValueError):
        spec.validate(["id", "updated"])
    with pytest.raises(LookupError):
        find_spec(specs, "old")
    with pytest.raises(ValueError):
        TableSpec("t", "t", strategy="scd2").validate([])
    df = spark.createDataFrame([(1, 2)], ["A  b", "a_b"])
    with pytest.raises(ValueError):
        standardize.clean_names(df)
    assert standardize.clean_names(spark.createDataFrame([(1, 2)], ["_Ab-C", "_row"]), ("_row",))[0].columns == ["ab_c", "_row"]
    assert current_view(spark.createDataFrame([(1, True, 2)], ["a", "_is_current", "_x"])).columns == ["a"]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(spark.createDataFrame([(1,)], "a int"), path)
    sinks.append(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert sinks.read_merged(spark, path).columns == ["a", "b"]
    sinks.write_once(spark.createDataFrame([(9,)], "a int"), path)
    assert sinks.read_merged(spark, path).count() == 2
    state = sinks.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert sorted(map(tuple, state.collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_null_keys_equal_times_and_reruns(spark):
    base = ready(table(spark, [(None, "a", 0), (1, "b", 0)]))
    batch = ready(table(spark, [(None, "a2", 4), (1, "b", 4)]))
    once = scd2.apply(base, batch, ["k", "g"], now())
    assert once.count() == 3 and once.where("k is null and _is_current").first().v == "a2"
    twice = scd2.apply(once, batch, ["k", "g"], now())
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    assert tuple(scd2.change_counts(scd2.judge(base, batch, ["k", "g"])).first()) == (0, 1, 1)
    state = sinks.upsert(spark.createDataFrame([(None, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(None, "z")], "k int, v string"), ["k"])
    assert sorted(map(tuple, state.collect()), key=repr) == [(2, "y"), (None, "z")]
    log = [(1, v, 3) for v in "cab"] + [(1, "d", 5)]
    tables = [rows(scd2.from_log(table(spark, order).repartition(n), ["k", "g"], "ts")) for order, n in ((log, 1), (log[::-1], 3))]
    assert tables[0] == tables[1] and len(tables[0]) == 4


def test_streams_write_only_what_a_batch_changes(spark, tmp_path):
    from scorelake.streaming import streams

    log = [(k, v, d) for k in range(4) for d, v in enumerate("aabca")]
    for day in range(5):
        table(spark, [r for r in log if r[2] == day]).write.mode("append").parquet(f"{tmp_path}/in")
        streams.scd2_available(streams.file_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema), f"{tmp_path}/state", f"{tmp_path}/checkpoint", ["k", "g"], "ts")
    assert rows(streams.scd2_table(spark, f"{tmp_path}/state")) == rows(scd2.from_log(table(spark, log), ["k", "g"], "ts"))
    assert spark.read.parquet(f"{tmp_path}/state/batch=1").where("_open = 0").count() == 0
    assert spark.read.parquet(f"{tmp_path}/state/batch=4").count() == 8
