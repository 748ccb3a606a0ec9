"""Tables in buckets: what a write leaves alone, and late rows in versioned tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

from scorelake.operators import scd2
from scorelake.sources import generations
from scorelake.streaming import streams

from .test_history import at, ready, rows, table

KEYS = ["k", "g"]


def files(path):
    """Path, size and time of each data file."""
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                s = os.stat(f"{folder}/{n}")
                found[f"{folder}/{n}".removeprefix(str(path))] = (s.st_size, s.st_mtime_ns)
    return found


def pairs(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def upsert(spark, path, rows, **options):
    return generations.merge(spark, path, pairs(spark, rows), ["k"], lambda old, new: generations.replace_keys(old, new, ["k"]), buckets=8, **options)


def test_an_upsert_leaves_other_buckets_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert generations.read(spark, path) is None and upsert(spark, path, []) == set() and generations.read(spark, path) is None
    upsert(spark, path, [(k, "old") for k in range(200)] + [(None, "old")])
    before = files(path)
    touched = upsert(spark, path, [(7, "new"), (None, "new"), (500, "new")])
    assert len(touched) <= 3
    after = files(path)
    assert all(after[f] == before[f] for f in before)  # same names, sizes and times
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in after.keys() - before.keys()} == touched
    want = {k: "old" for k in range(200)} | {7: "new", 500: "new", None: "new"}
    assert sorted(map(tuple, generations.read(spark, path).collect()), key=repr) == sorted(want.items(), key=repr)
    assert generations.vacuum(spark, path) == len(touched)
    assert generations.read(spark, path).count() == len(want)
    with pytest.raises(ValueError):
        generations.merge(spark, path, pairs(spark, [(1, "x")]), ["k"], lambda old, new: new, buckets=9)


def test_dead_and_repeated_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, [(k, "a") for k in range(20)], generation=0)
    upsert(spark, path, [(3, "b")], generation=1)
    once = sorted(map(tuple, generations.read(spark, path).collect()))
    upsert(spark, path, [(3, "b")], generation=1)
    assert sorted(map(tuple, generations.read(spark, path).collect())) == once
    os.remove(f"{path}/buckets=8/generation=1/_SUCCESS")  # a run that died while writing
    assert dict(map(tuple, generations.read(spark, path).collect()))[3] == "a"

    def fails(old, new):
        raise RuntimeError("dies")

    with pytest.raises(RuntimeError):
        generations.merge(spark, path, pairs(spark, [(4, "c")]), ["k"], fails, buckets=8)
    assert dict(map(tuple, generations.read(spark, path).collect()))[4] == "a"


def test_added_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, [(k, "a") for k in range(20)])
    more = spark.createDataFrame([(3, "b", 1.5)], "k int, v string, w double")
    generations.merge(spark, path, more, ["k"], lambda old, new: generations.replace_keys(old, new, ["k"]), buckets=8)
    got = {r.k: (r.v, r.w) for r in generations.read(spark, path).collect()}
    assert len(got) == 20 and got[3] == ("b", 1.5) and got[4] == ("a", None)


LOG = [(k, v, d) for k in (0, 1, None) for d, v in enumerate("aabcaaabba")] + [(1, "z", 3), (1, "y", 3), (2, "a", 0), (2, "a", 9)]


@pytest.mark.parametrize("seed", range(4))
def test_any_arrival_order_gives_the_rows_of_the_whole_log(spark, tmp_path, seed):
    rnd = random.Random(seed)
    log = LOG[:]
    rnd.shuffle(log)
    want = rows_of(scd2.from_log(table(spark, LOG), KEYS, "ts"))
    spliced, cuts = None, sorted(rnd.sample(range(1, len(log)), 3))
    for part in (log[: cuts[0]], log[cuts[0] : cuts[1]], log[cuts[1] : cuts[2]], log[cuts[2] :], log[:5], []):
        spliced = scd2.splice(spliced, table(spark, part), KEYS, "ts")
        spliced.write.parquet(f"{tmp_path}/{len(os.listdir(tmp_path))}")
        spliced = spark.read.parquet(f"{tmp_path}/{len(os.listdir(tmp_path)) - 1}")
    assert rows_of(scd2.spliced_versions(spliced)) == want
    assert spliced.count() == len(LOG)


def rows_of(df):
    return sorted(((r.k, r.v, r._is_current, r._effective_from, r._effective_to) for r in df.collect()), key=repr)


def test_a_late_row_before_a_repeat_splits_the_version(spark):
    spliced = scd2.splice(None, table(spark, [(1, "a", 0), (1, "a", 5)]), KEYS, "ts")
    assert rows(scd2.spliced_versions(spliced)) == [(1, "a", True, at(0), None)]
    spliced = scd2.splice(spliced, table(spark, [(1, "b", 2)]), KEYS, "ts")
    assert rows(scd2.spliced_versions(spliced)) == [(1, "a", False, at(0), at(2)), (1, "a", True, at(5), None), (1, "b", False, at(2), at(5))]


def test_shuffled_streams_equal_the_whole_log(spark, tmp_path):
    log = [(k, v, d) for k in range(12) for d, v in enumerate("aabcab")]
    random.Random(5).shuffle(log)
    schema = table(spark, log).schema
    for i in range(0, len(log), 24):
        table(spark, log[i : i + 24]).write.mode("append").parquet(f"{tmp_path}/in")
        streams.scd2_any_order(streams.file_stream(spark, f"{tmp_path}/in", schema), f"{tmp_path}/state", f"{tmp_path}/checkpoint", KEYS, "ts", 8)
    assert rows(streams.spliced_table(spark, f"{tmp_path}/state")) == rows(scd2.from_log(table(spark, log), KEYS, "ts"))


def test_the_ordered_stream_refuses_late_rows(spark, tmp_path):
    for part in ([(1, "a", 0), (1, "c", 5)], [(1, "b", 2)]):
        table(spark, part).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.file_stream(spark, f"{tmp_path}/in", table(spark, part).schema)
        run = lambda: streams.scd2_available(stream, f"{tmp_path}/state", f"{tmp_path}/checkpoint", KEYS, "ts")  # noqa: B023, E731
        if part[0][1] == "a":
            run()
        else:
            with pytest.raises(Exception, match="comes after a later one"):
                run()


def test_all_change_counts_sum_to_the_batch(spark):
    base = ready(table(spark, [(1, "a", 3), (2, "b", 3), (3, "c", 3), (6, "f", 3)]))
    batch = ready(table(spark, [(1, "late", 1), (2, "gone", 5), (3, "c", 5), (4, "gone", 5), (5, "x", 2), (6, "g", 4)]))
    got = scd2.all_change_counts(scd2.judge(base, batch, KEYS, F.col("v") == "gone")).first().asDict()
    assert got == {"new_rows": 1, "changed_rows": 1, "unchanged_rows": 1, "late_rows": 1, "deleted_rows": 1, "none_rows": 1, "batch_rows": 6}
