import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from scorelake.llm import warc
from scorelake.llm._spark import scratch_path


def rows():
    big = "<p>" + "héllo " * 50_000
    return [(1, "http://a", "x"), (2, None, "x"), (3, "http://b c\n", None), (4, "u", ""), (5, "u", "é"), (None, "n", "x"), (None, "m", "alone"), (6, "big", big), (7, "big", big + "!")]


def expected(min_bytes, pages=None):
    data = [(i, (h or "").encode()) for i, _, h in pages or rows()]
    out = []
    for i, p in data:
        ids = [j for j, q in data if q == p and j is not None]
        lead = max(ids) if ids and len(p) >= min_bytes else i
        kind = "response" if lead == i else "revisit"
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), kind, lead if kind == "revisit" else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 1, 10])
def test_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string").repartition(3).withColumn("kind", F.lit("clash"))
    folder = scratch_path(spark, "warc-test")
    warc.write_warc(pages, folder, min_bytes, roll_bytes=300)
    records = warc.read_warc(spark, folder)
    got = sorted((tuple(r) for r in warc.resolve_revisits(records).collect()), key=repr)
    assert got == expected(min_bytes)
    stored = {r.page_id: bytes(r.payload) for r in records.where("record_type = 'response'").collect()}
    assert all(stored[i] == (h or "").encode() for i, _, h in rows() if i in stored and i is not None)


def test_same_bytes_again_and_files_roll(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    manifests = []
    for parts in (1, 4):
        folder = scratch_path(spark, "warc-test")
        manifests.append(sorted(map(tuple, warc.write_warc(pages.repartition(parts), folder, roll_bytes=300).collect())))
    assert manifests[0] == manifests[1] and len(manifests[0]) > 1
    path = folder.removeprefix("file://") + "/" + manifests[1][0][0]
    text = gzip.decompress(open(path, "rb").read())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_empty_table(spark):
    folder = scratch_path(spark, "warc-test")
    assert warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder).count() == 0
    assert warc.read_warc(spark, folder).count() == 0


def test_many_pages_of_one_id_fall_into_several_files(spark):
    pages = spark.createDataFrame([(None, "u", f"page {i}") for i in range(60)] + [(3, "u", f"three {i % 9}") for i in range(60)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(pages, folder, rows_per_range=10).collect()
    assert len(manifest) > 6 and sum(r.records for r in manifest) == 120
    records = warc.read_warc(spark, folder).collect()
    assert sorted((r.page_id is None, bytes(r.payload)) for r in records) == sorted((i is None, h.encode()) for i, _, h in map(tuple, pages.collect()))


@pytest.mark.parametrize("share", [0.0, 0.2, 1.0])
def test_a_third_of_all_pages_has_one_payload(spark, monkeypatch, share):
    """Payloads joined by broadcast, by shuffle or by both, with a page that is repeated and one whose target is gone."""
    monkeypatch.setattr(warc, "HOT_SHARE", share)
    data = [(i, "u", "one payload") for i in range(300)] + [(300 + i, "u", f"pair {i // 2}") for i in range(200)] + [(i, "v", None) for i in range(500, 600)]
    data += [(900, "r", "said again")] * 100 + [(i, "r", "said again") for i in range(700, 720)] + [(None, "n", "said again"), (None, "n", "no ids"), (None, "n", "no ids")]
    folder = scratch_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(data, "page_id long, url string, html string").repartition(5), folder, rows_per_range=50)
    records = warc.read_warc(spark, folder, with_payload=False)
    assert sorted((tuple(r) for r in warc.resolve_revisits(records).collect()), key=repr) == expected(0, data)
    without = warc.resolve_revisits(records.where("not (page_id <=> 900)")).collect()
    assert len(without) == len(data) - 100 and all(r.refers_to is None for r in without if r.page_id in range(700, 720))
    assert warc.resolve_revisits(records.where("record_type = 'response'")).where("refers_to is not null").count() == 0
