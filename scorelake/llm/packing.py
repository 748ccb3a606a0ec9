"""Vector best-fit packing of tokenised documents into sequences.

Texts are tokenised where they are read; longer documents are cut so that the first piece takes
the remainder and all others are full.  A piece is a vector (tokens, one document, attention cost
= length squared) and a sequence has a capacity in each.  Pieces are taken in order of falling
length; a piece goes to the open sequence that has room in every dimension and scores best: the
largest weighted dot product of piece and residual, or the smallest norm of what would be left.

Pieces of one length are the same vector, so the choice is made for all of them together: it needs
only the number of pieces of each length (at most ``capacity`` numbers, whatever the corpus), and
each step places as many as there are sequences in the best state.  The outcome, runs of "the a-th
to b-th piece of length n go to sequences x onward at offset o", is a table whose size depends on
the capacity alone.  Pieces find their run by their rank among those of their length, which comes
from counts per (length, hash bucket), so one length that holds a third of all pieces is shared out.

Null counts as empty: one piece, the end token.  Repeated rows are packed each on its own; pieces of
equal length take places by id, and those equal in all are interchangeable.  Texts are encoded
whole, however long.  Columns other than doc_id and text are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import map_arrow, materialise

CAPACITY = 1024
END_TOKEN = 2
VOCABULARY = "byte_bpe_50k.json"


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed value: the splitter of byte-level vocabularies of this family.
SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE file of ``tokenizers``; ids rise in merge order."""
    vocabulary = json.loads(Path(path).read_text())["model"]["vocab"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(letter[c] for c in token): i for token, i in vocabulary.items() if all(c in letter for c in token)}


def added_tokens(path: str) -> dict[str, int]:
    """Strings and ids of the file's added tokens, which are taken from the text before it is split."""
    found = json.loads(Path(path).read_text())["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError("added tokens that depend on their surroundings aren't supported")
    return {t["content"]: t["id"] for t in found}


class Encoder:
    """Ids of whole texts, those of ``Tokenizer.encode(text, add_special_tokens=False)`` for the file.

    tiktoken's encoder runs the vocabulary: measured at 6.3 MB a second and core against 1.3 to
    1.7 for ``tokenizers`` itself.  Strings of added tokens in a text get these tokens' ids.
    """

    def __init__(self, path: str):
        import tiktoken

        ranks = byte_ranks(path)
        # Ids are dense up to the special tokens, which stand after the merges.
        ranks = {token: i for token, i in ranks.items() if i < len(ranks)}
        self.encoder = tiktoken.Encoding("packing", pat_str=SPLITTER, mergeable_ranks=ranks, special_tokens=added_tokens(path))

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        ids = self.encoder.encode(text, allowed_special="all")
        return struct.pack(f"<{len(ids)}I", *ids)


def tokenise(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = encoder.encode(text.as_py() or "") + END_TOKEN.to_bytes(4, "little")
                n = len(raw) // 4
                start, length, piece = 0, n % capacity or capacity, 0
                while start < n:
                    out.append((doc_id, piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
                    start, length, piece = start + length, capacity, piece + 1
            columns = zip(*out) if out else [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int, max_docs: int, max_attention: int, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.05, 0.25)) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first sequence, offset).

    Open sequences of the same residual vector are kept as one state with the ranges of their
    numbers.  ``rule`` is "dot" (largest weighted dot product) or "norm" (smallest weighted norm
    of what would be left); full sequences are closed.
    """
    full = np.array([capacity, max_docs, max_attention], np.float64)
    scale = np.array(weights) / full**2
    states: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    runs, fresh = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        item = np.array([length, 1, length * length], np.float64)
        if (item > full).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            room = np.array(list(states), np.float64).reshape(-1, 3)
            fits = np.flatnonzero((room >= item).all(axis=1))
            if len(fits):
                rest = room[fits]
                points = rest @ (item * scale) if rule == "dot" else -(((rest - item) ** 2) @ scale)
                state = list(states)[fits[np.argmax(points)]]
                first, number = states[state].pop()
                if not states[state]:
                    del states[state]
                take = min(left, number)
                if take < number:
                    states.setdefault(state, []).append((first + take, number - take))
            else:
                state, first = (capacity, max_docs, max_attention), fresh
                # As many of this length as one sequence holds go together before the next is opened.
                each = min(int(capacity // length), max_docs, max_attention // (length * length))
                take = max(1, left // each)
                fresh += take
            runs.append((length, rank, rank + take, first, capacity - state[0]))
            after = (state[0] - length, state[1] - 1, state[2] - length * length)
            if after[0] > 0 and after[1] > 0 and after[2] > 0:
                states.setdefault(after, []).append((first, take))
            left, rank = left - take, rank + take
    return runs


def pack(
    docs: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None, max_attention: int | None = None, rule: str = "norm", path: str | None = None, buckets: int | None = None,
) -> DataFrame:
    """Pieces with sequence_id and offset.

    By default the document count and attention cost allow whatever the tokens allow.
    """
    max_docs, max_attention = max_docs or capacity, max_attention or capacity * capacity
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = materialise(
        tokenise(docs, capacity, path).withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")), "packing-pieces"
    )
    per_bucket = pieces.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    counts = {r["length"]: r["n"] for r in per_bucket.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    runs = best_fit(counts, capacity, max_docs, max_attention, rule)
    plan = spark.createDataFrame(runs or [(0, 0, 0, 0, 0)], "length long, _from long, _to long, _first long, offset long")
    # Counts before each bucket, per length: at most capacity times buckets rows, none larger for a common length.
    earlier = per_bucket.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    in_bucket = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("_nth", F.row_number().over(in_bucket) - 1).join(earlier.drop("_n"), ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_nth"))
    # The plan's size is bounded by the capacity.
    found = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).drop(plan["length"])
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"), "offset")
