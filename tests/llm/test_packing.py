import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelake.llm import packing


def reference_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    return lambda text: [*t.encode(text, add_special_tokens=False).ids, packing.END_TOKEN]


def texts():
    rnd = random.Random(1)
    words = ["the", "é", "\n\n", "  ", "<|endoftext|>", "x1", "it's", "日本", "\t", "!!", "Wörter", "\0", "🙂"]
    return [None, "", " ", "a" * 9000] + [rnd.choice(["", " "]).join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 40, 300]))) for _ in range(60)]


@pytest.mark.parametrize(("capacity", "max_docs", "max_attention", "rule"), [(64, None, None, "norm"), (64, 3, None, "dot"), (50, None, 900, "norm")])
def test_pieces_ids_and_constraints(frame, capacity, max_docs, max_attention, rule):
    data = [(i, t) for i, t in enumerate(texts())] + [(3, "again"), (None, "no id")]
    if max_attention:
        data = [(i, t) for i, t in data if len(reference_ids()(t or "")) <= 30]
    rows = packing.pack(frame(data).withColumn("length", F.lit("x")), capacity, max_docs, max_attention, rule).collect()
    ids = reference_ids()
    want = []
    for doc_id, text in data:
        all_ids, start = ids(text or ""), 0
        length, piece = len(all_ids) % capacity or capacity, 0
        while start < len(all_ids):
            part = np.array(all_ids[start : start + length], "<u4").tobytes()
            want.append((doc_id, piece, start, length, zlib.crc32(part)))
            start, length, piece = start + length, capacity, piece + 1
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity and len(parts) <= (max_docs or capacity)
        assert sum(n * n for _, n in parts) <= (max_attention or capacity**2)
    total = sum(r.length for r in rows)
    if not max_docs and not max_attention:
        assert len(bins) <= -(-total // capacity) + 2


def test_best_fit_is_near_the_bound():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 1024, 20_000)
    counts = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True))}
    runs = packing.best_fit(counts, 1024, 1024, 1024**2)
    assert max(first + end - start for _, start, end, first, _ in runs) <= lengths.sum() / 1024 * 1.01


def test_empty_table(frame):
    assert packing.pack(frame([])).collect() == []


def test_added_tokens_keep_their_ids(spark, tmp_path):
    import corpus_pipeline
    from scorelake.llm import queries
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path())
    rnd = random.Random(5)
    glue = lambda: "".join(rnd.choice(["<|endoftext|>", " ", "\n", "  \n ", "it's", "x1", "<|endoftext", "|>", "\u00e9\U0001f642", " the"]) for _ in range(rnd.choice([2, 9, 60])))
    data = [(0, "abc <|endoftext|> def"), (1, "<|endoftext|>" * 2000), (2, None)] + [(3 + i, glue()) for i in range(200)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc_id, text in data:
        ids, start, piece = [*t.encode(text or "", add_special_tokens=False).ids, packing.END_TOKEN], 0, 0
        length = len(ids) % 1024 or 1024
        while start < len(ids):
            want.append((doc_id, piece, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())))
            start, length, piece = start + length, 1024, piece + 1
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (queries.op1_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path))):
        assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got.collect()) == sorted(want)
