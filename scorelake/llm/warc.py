"""WARC archives: a deterministic sharded writer and a reader.

Pages are cut into ranges of page_id and payload digest (cut points from the pairs that hash
smallest, so they depend on the data alone, and many pages of one id fall into several ranges),
each range is sorted by one task and written as gzip members, one a record, into files that roll
at ``roll_bytes`` of compressed size.  Headers and digests are worked
out anew, record ids are name-based UUIDs, the date is an argument: the same pages give the same
bytes.

Commit: a task writes to a name of its own under ``_temporary``; the rows that Spark commits to
``_pending`` name the files of the attempts that counted; those are renamed to their final names
(a rename that was done is skipped), and the manifest is written last.  A reader takes only files
that the manifest lists, so a lost executor or a rerun leaves no half of an archive behind.

Of pages with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the largest
page_id is stored and the others are revisit records that refer to it.  Payloads are deduplicated
by digest in a narrow table, which is written once; the pages themselves are shuffled once.

A null payload counts as empty, a null url leaves the field out; null ids come first and refer
to a page with an id where there is one; rows that repeat the stored page's id and payload are
stored too.  Extra columns are ignored.  An empty table gives an empty manifest.  Archive folders are reached by pyarrow (file, hdfs, s3,
gs); pages by any reader of Spark.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._ranges import MOST_RANGES, NO_ID, cut_points, range_number
from ._spark import drop_scratch, materialise

ROLL_BYTES = 16 << 20
ROWS_PER_RANGE = 20_000
#: A payload with more than this share of all pages that have copies is joined by broadcast; fewer than 1,000 can be.
HOT_SHARE = 0.001
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("5f0c0a0e-58d8-5b0b-9a6e-3c1d0f6f2b11")

MANIFEST = "name string, temporary string, records long, bytes long, sha256 string"


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _record(page_id: int | None, url: str | None, payload: bytes, digest: str, lead: tuple | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if lead else http + payload
    fields = [("WARC-Type", "revisit" if lead else "response"), ("WARC-Record-ID", record_urn(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).hexdigest())}")]
    if lead:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_urn(lead[0], digest)), ("WARC-Truncated", "length")]
    return _member([*fields, ("Content-Type", "application/http;msgtype=response")], block)


def _meet(rows: DataFrame, leads: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``leads``, a row a key, whose ``_n`` says how many rows have the key.

    The rows of a hot key would meet in one task, so they don't move: the keys above HOT_SHARE of all are broadcast.
    """
    least = HOT_SHARE * (leads.agg(F.sum("_n")).first()[0] or 0)
    hot, others = leads.where(F.col("_n") > least).drop("_n"), leads.where(F.col("_n") <= least).drop("_n")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(others, key, how)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def write_warc(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, roll_bytes: int = ROLL_BYTES, rows_per_range: int = ROWS_PER_RANGE, date: str = DATE) -> DataFrame:
    """Write the archives under ``folder``; the manifest (name, records, bytes, sha256) is returned."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digests = materialise(pages.select("page_id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size")), "warc-digests")
    narrow = digests.where(F.col("size") >= min_revisit_bytes)
    leads = materialise(narrow.groupBy("digest").agg(F.max("page_id").alias("lead"), F.count("*").alias("_n")).where("_n > 1"), "warc-leads")
    revisits = _meet(narrow, leads, "digest").where("not (page_id <=> lead)").select("page_id", "digest", "lead").distinct()

    # The first 60 bits of a digest stand in its order.
    place = [F.coalesce("page_id", F.lit(NO_ID)), F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")]
    cuts = cut_points(digests.select(place[0].alias("id"), place[1].alias("hash")), rows_per_range)

    # A page's revisit marks come before the page in the sort.
    marks = revisits.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "digest", "lead", F.lit(0).alias("kind"))
    whole = pages.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.lit(None).cast("long").alias("lead"), F.lit(1).alias("kind"))
    dealt = marks.unionByName(whole).withColumn("range", range_number(*place, cuts))
    ordered = dealt.repartitionById(len(cuts[0]) + 1, F.col("range")).sortWithinPartitions("range", "page_id", "digest", "kind", "url")
    pending = ordered.mapInArrow(_writer(folder, roll_bytes, date), MANIFEST)
    pending.write.mode("overwrite").parquet(f"{folder}/_pending")
    for table in (digests, leads):
        drop_scratch(spark, table)
    chosen = spark.read.schema(MANIFEST).parquet(f"{folder}/_pending")
    chosen.repartition(max(1, min(200, chosen.count()))).mapInArrow(_renamer(folder), MANIFEST).drop("temporary").write.mode("overwrite").parquet(f"{folder}/manifest")
    file_system, path = pyarrow.fs.FileSystem.from_uri(f"{folder}/_temporary")
    if file_system.get_file_info(path).type == pyarrow.fs.FileType.Directory:
        file_system.delete_dir(path)
    return spark.read.parquet(f"{folder}/manifest")


def _writer(folder: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, base = pyarrow.fs.FileSystem.from_uri(folder)
        attempt = uuid.uuid4().hex
        members: list[bytes] = []
        done: list[tuple] = []
        at, number, size = None, 0, 0

        def close() -> None:
            nonlocal members, number, size
            if not members:
                return
            info = b"software: sharded-warc-writer\r\nformat: WARC File Format 1.1\r\n"
            name = f"range-{at:05d}-{number:05d}.warc.gz"
            first = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_urn(None, name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info)
            body = b"".join([first, *members])
            temporary = f"_temporary/{attempt}/{name}"
            file_system.create_dir(f"{base}/_temporary/{attempt}", recursive=True)
            with file_system.open_output_stream(f"{base}/{temporary}", compression=None) as out:
                out.write(body)
            done.append((name, temporary, len(members), len(body), hashlib.sha256(body).hexdigest()))
            members, number, size = [], number + 1, 0

        mark: tuple | None = None
        for batch in batches:
            ids, urls, payloads, digests, leads, kinds, ranges = batch.columns
            for i in range(batch.num_rows):
                if ranges[i].as_py() != at:
                    close()
                    at, number = ranges[i].as_py(), 0
                page_id, digest = ids[i].as_py(), digests[i].as_py()
                if kinds[i].as_py() == 0:
                    mark = (page_id, digest, leads[i].as_py())
                    continue
                lead = (mark[2],) if mark and mark[:2] == (page_id, digest) else None
                members.append(_record(page_id, urls[i].as_py(), payloads[i].as_py(), base32(digest), lead, date))
                size += len(members[-1])
                if size >= roll_bytes:
                    close()
        close()
        columns = zip(*done) if done else [()] * 5
        types = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["name", "temporary", "records", "bytes", "sha256"])

    return write


def _renamer(folder: str):
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                old, new = file_system.get_file_info([f"{base}/{temporary}", f"{base}/{name}"])
                if old.type != pyarrow.fs.FileType.NotFound:
                    file_system.move(old.path, new.path)
                elif new.type == pyarrow.fs.FileType.NotFound:
                    raise FileNotFoundError(name)
            yield batch

    return rename


RECORDS = "page_id long, url string, record_id string, record_type string, refers_to_id string, payload_bytes long, payload_digest string, payload binary"


def read_warc(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of all files that the manifest lists; digests are checked."""
    names = spark.read.parquet(f"{folder}/manifest").select("name")
    # Several files a task where there are many; a file is read as a stream.
    files = names.repartition(max(1, min(names.count(), MOST_RANGES)), "name")
    keep = with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_system, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with file_system.open_input_stream(f"{base}/{name}", compression=None) as source:
                    held, size = [], 0
                    for record in _records(source):
                        if (row := _row(*record, keep)) is not None:
                            held.append(row)
                            size += len(row[-1] or b"") + 400
                        if size > 4 << 20:
                            yield _batch(held)
                            held, size = [], 0
                    if held:
                        yield _batch(held)

    return files.mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=[f.split()[0] for f in RECORDS.split(", ")])


def _records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each gzip member."""
    unpack, parts, rest = zlib.decompressobj(31), [], source.read(1 << 20)
    while rest:
        parts.append(unpack.decompress(rest))
        rest = unpack.unused_data
        if unpack.eof:
            head, _, body = b"".join(parts).partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            yield fields, body[: int(fields["Content-Length"])]
            unpack, parts = zlib.decompressobj(31), []
        rest = rest or source.read(1 << 20)


def _row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple | None:
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: its payload differs from its digest")
    page_id = int(fields["Page-ID"]) if "Page-ID" in fields else None
    return page_id, fields.get("WARC-Target-URI"), fields["WARC-Record-ID"], kind, fields.get("WARC-Refers-To"), size, digest, payload if with_payload and kind == "response" else None


def resolve_revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, the page that a revisit's target stands for."""
    revisits = records.where("record_type = 'revisit'")
    wanted = revisits.groupBy("refers_to_id").agg(F.count("*").alias("_n"))
    # A record id stands for one page id, and repeated rows of a page share it.
    stored = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to"))
    targets = materialise(stored.join(wanted, "refers_to_id"), "warc-targets")
    # Responses refer to nothing and stay out of the join.
    own = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    resolved = _meet(revisits, targets, "refers_to_id", "left").unionByName(own)
    return resolved.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
