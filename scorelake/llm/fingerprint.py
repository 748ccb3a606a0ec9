"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is a sentence of a line, trimmed, or the whole line if it has one: texts without line breaks
have parts that way.  Below it stand its pairs of neighbouring words (its word, where it has one), so that
a text of one or two sentences has parts that outlive an edit too.  Each part is hashed to a wide vector of
+1 and -1 lanes, and a document's fingerprint is the sum of the vectors modulo 2**32: independent of their
order, and updated by adding or subtracting single parts.  The text as a whole adds nothing, so two texts
with the same paragraphs in another order are equal on purpose.

The sums are also a linear sketch: the cosine of two fingerprints (lanes read as signed numbers)
estimates that of their multisets of parts, with a standard error of about 1/sqrt(lanes).

Null counts as the empty text, whose fingerprint is zero; repeated rows have equal fingerprints.
Texts are used whole, and lanes hold the sums of two thousand million parts.  Columns other than
doc_id and text are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import batched, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_arrow
from ._ranges import NO_ID, cut_points, range_number

LANES = 256
PART = re.compile(r"[^.!?\r\n]+[.!?]*")


def paragraphs(text: str) -> Iterator[bytes]:
    """The text's sentences, each followed by its pairs of words."""
    for m in PART.finditer(text):
        if sentence := m[0].strip().encode("utf-8", "surrogatepass"):
            yield sentence
            words = sentence.split()
            if len(words) < 2:
                yield from words
            for one, two in pairwise(words):
                yield b"%b %b" % (one, two)


def digest(part: bytes) -> bytes:
    """The lanes of one part as bits."""
    return hashlib.blake2b(part, digest_size=LANES // 8).digest()


def vector(part: bytes) -> np.ndarray:
    """+1 / -1 lanes of one part."""
    bits = np.unpackbits(np.frombuffer(digest(part), np.uint8))
    return bits.astype(np.int32) * np.int32(2) - np.int32(1)


def multiset_sum(parts: Iterable[bytes]) -> np.ndarray:
    """Sum of the parts' vectors, modulo 2**32."""
    ones, n = np.zeros(LANES, np.int64), 0
    for some in batched(parts, 4096):
        digests = b"".join([digest(p) for p in some])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, LANES // 8), axis=1).sum(axis=0, dtype=np.uint16)
        n += len(some)
    return (2 * ones - n).astype(np.int32)


def insert(fingerprint: np.ndarray, part: bytes) -> np.ndarray:
    return fingerprint + vector(part)


def delete(fingerprint: np.ndarray, part: bytes) -> np.ndarray:
    return fingerprint - vector(part)


def encode(fingerprint: np.ndarray) -> str:
    return base64.b64encode(fingerprint.astype("<i4").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<i4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal fingerprints; else the estimated cosine of the multisets of parts, in [0, 1)."""
    if np.array_equal(a, b):
        return 1.0
    x, y = a.astype(np.float64), b.astype(np.float64)
    size = np.sqrt((x @ x) * (y @ y))
    return float(min(max(x @ y / size, 0.0), 1 - 1e-9)) if size else 0.0


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def untouched(text: str) -> int:
    """Where the last sentence ends that ``edited`` surely leaves as it is: the parts before this place are in both texts."""
    kept, place = len(text) - len(text) // 2, 0
    for m in PART.finditer(text, 0, kept):
        if m.end() < kept:
            place = m.end()
    return place


def fingerprint_pairs(docs: DataFrame, rows_per_range: int = 20_000) -> DataFrame:
    """Per document: its fingerprint, its edited text's, and how alike they and the next document's are.

    The next document is the one with the next smaller doc_id (after the smallest, the largest).
    Documents are dealt to ranges once, one a task, and each range also gets the first document of
    the range below it, so one shuffle of the texts is all.  Null ids come last; rows of one id are
    ordered by their texts' hashes, so they fall into several ranges where they are many.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "hash": F.xxhash64("text")})
    dealt = keyed.withColumn("range", range_number(F.col("id"), F.col("hash"), cut_points(keyed.select("id", "hash"), rows_per_range)))
    # The first document of each range is a guest of the range above it, and that of the last one of the lowest range; this table has a row a range.
    tops = sorted((r["range"], r["top"]["id"], r["top"]["hash"]) for r in dealt.groupBy("range").agg(F.max(F.struct("id", "hash")).alias("top")).collect())
    heads = docs.sparkSession.createDataFrame([(r, i, h, tops[(k + 1) % len(tops)][0]) for k, (r, i, h) in enumerate(tops)], "range int, top_id long, top_hash long, host int")
    own, guest = F.struct(F.col("range").alias("at"), F.lit(False).alias("guest")), F.struct(F.col("host").alias("at"), F.lit(True).alias("guest"))
    rows = (
        dealt.join(F.broadcast(heads), "range")
        .withColumn("homes", F.when((F.col("id") == F.col("top_id")) & (F.col("hash") == F.col("top_hash")), F.array(own, guest)).otherwise(F.array(own)))
        .select("doc_id", "text", "id", "hash", F.explode("homes").alias("home"))
    )
    n = max(1, tops[-1][0] + 1 if tops else 1)
    ordered = rows.select("doc_id", "text", "home.at", "home.guest", "id", "hash").repartitionById(n, F.col("at")).sortWithinPartitions("at", "guest", F.desc("id"), F.desc("hash"), "text")
    return map_arrow(ordered.select("doc_id", "text", "at", "guest"), _compare, SCHEMA)


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None  # a document whose next one hasn't come yet
    out: list[tuple] = []

    def finish(one: tuple, following: str, other: np.ndarray) -> tuple:
        doc_id, text, own, place, start = one
        new = edited(text, following)
        changed = start + multiset_sum(paragraphs(new[place:]))
        return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), encode(own), encode(changed), likeness(own, changed), likeness(own, other)

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    kinds = [types[part.split()[1]] for part in SCHEMA.split(", ")]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)
    held_at = None
    for batch in batches:
        ids, texts, ats, guests = (batch.column(i) for i in range(4))
        for i in range(batch.num_rows):
            at, guest, text = ats[i].as_py(), guests[i].as_py(), texts[i].as_py()
            if guest and (held is None or held_at != at):
                continue  # a second guest of the range
            place = untouched(text)
            start = multiset_sum(paragraphs(text[:place]))
            own = start + multiset_sum(paragraphs(text[place:]))
            if held is not None and held_at == at:
                out.append(finish(held, text, own))
            held, held_at = (None, None) if guest else ((ids[i].as_py(), text, own, place, start), at)
            if len(out) >= 2000:
                yield pack(out)
                out = []
    if out:
        yield pack(out)
