"""Very long texts, repeated rows and empty side tables; the classifier against plain loops."""

import random
import zlib
from collections import Counter
from math import exp

import numpy as np
import pytest

import corpus_pipeline
from scorelake.llm import packing, quality, secrets, sharding
from scorelake.llm._spark import materialise

LONG = "one two three\n" * 60_000 + "é end."


def features_by_hand(text):
    words, raw = [w.encode() for w in text.split(" ") if w], text.encode()
    pairs = ["twice" if a == b else (a, b) for a, b in zip(words, words[1:])]
    return Counter([*words, *pairs, *((n, raw[i : i + n]) for n in quality.CHAR_GRAMS for i in range(len(raw) - n + 1))])


def test_features_equal_brute_force():
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["a", "bc", "Bc", "dé", "efghij", "x-y"]) for _ in range(rnd.randrange(9))) for _ in range(12)]
    raw = [t.encode() for t in texts]
    ids, owner = quality.feature_ids(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 1 << 62)
    found = [Counter(ids[owner == i].tolist()) for i in range(len(texts))]
    want = [features_by_hand(t) for t in texts]
    for a, x in zip(found, want):
        assert sorted(a.values()) == sorted(x.values())
        for b, y in zip(found, want):
            assert (a & b).total() == (x & y).total()


def test_training_equals_plain_loops():
    features = [([0, 2], [0.25, 0.75]), ([1, 2, 3], [0.5, 0.25, 0.25]), ([3], [1.0])]
    labels, buckets, dim, rate, epochs = [1, 0, 1], 4, 2, 0.5, 3
    rng = np.random.default_rng(7)
    table = ((rng.random((buckets, dim), np.float32) * 2 - 1) / np.float32(dim)).tolist()
    out, bias, step = [[0.0, 0.0] for _ in range(dim)], [0.0, 0.0], 0
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            ids, share = features[i]
            speed = rate * (1 - step / (epochs * len(features))) * (len(labels) / (2 * labels.count(labels[i]))) ** 0.5
            step += 1
            hidden = [sum(s * table[f][d] for f, s in zip(ids, share)) for d in range(dim)]
            odds = [exp(sum(hidden[d] * out[d][c] for d in range(dim)) + bias[c]) for c in (0, 1)]
            error = [odds[c] / sum(odds) - (c == labels[i]) for c in (0, 1)]
            back = [sum(out[d][c] * error[c] for c in (0, 1)) for d in range(dim)]
            for d in range(dim):
                for c in (0, 1):
                    out[d][c] -= speed * hidden[d] * error[c]
                for f, s in zip(ids, share):
                    table[f][d] -= speed * s * len(ids) ** 0.5 * back[d]
            bias = [b - 0.1 * speed * e for b, e in zip(bias, error)]
    model = quality.train([(np.array(i), np.array(s, np.float32)) for i, s in features], np.array(labels), buckets, dim, epochs, rate)
    assert model.weight == pytest.approx([sum(row[d] * (out[d][1] - out[d][0]) for d in range(dim)) for row in table], abs=1e-5)
    assert model.bias == pytest.approx(bias[1] - bias[0], abs=1e-5)


def test_scores_of_long_and_repeated_texts(frame):
    rng = np.random.default_rng(5)
    model = quality.Model(rng.normal(size=1 << 10).astype(np.float32) * 9, 0.25)
    texts = [LONG, "short text", None, "", LONG + "?", "short text"]
    got = {r.doc_id: r.score for r in quality.score(frame(list(enumerate(texts))), model, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        ids, _ = quality.feature_ids(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 1 << 10)
        mean = float(model.weight[ids].astype(float).mean()) if len(ids) else 0.0
        assert got[i] == pytest.approx(1 / (1 + exp(-mean - 0.25)))
    assert got[1] == got[5] and got[2] == got[3]


def test_shards_packing_and_secrets_of_long_and_repeated_texts(frame):
    rows = [(1, LONG), (1, LONG), (2, None), (3, "password=hunter2secret"), (3, "password=hunter2secret"), (4, LONG + " token: abcdefgh12")]
    shards = sharding.shard_by_bytes(frame(rows), 4).collect()
    assert sorted(r.doc_id for r in shards) == [1, 1, 2, 3, 3, 4]
    encode = packing.Encoder(packing.tokenizer_path()).encode
    pieces = packing.pack(frame(rows), 1024).collect()
    for doc_id, copies in Counter(i for i, _ in rows).items():
        ids = np.append(np.frombuffer(encode(dict(rows)[doc_id] or ""), "<u4"), np.uint32(packing.END_TOKEN)).astype("<u4")
        mine = [p for p in pieces if p.doc_id == doc_id]
        assert sum(p.length for p in mine) == copies * len(ids)
        assert {(p.start, p.ids_crc32) for p in mine} == {(p.start, zlib.crc32(ids[p.start : p.start + p.length].tobytes())) for p in mine}
    found = secrets.digest_columns(secrets.scan_secrets(frame(rows))).collect()
    assert sorted((r.doc_id, r.n_assign) for r in found) == [(1, 0), (1, 0), (2, 0), (3, 1), (3, 1), (4, 1)]


def test_pipeline_without_labels_and_benchmark(spark, tmp_path):
    """With nothing to learn from every score is 0.5 and stays; without items nothing is contaminated."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["first text of some words here", "another text with other words", None, "", LONG]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, str(tmp_path)), "test-stage")
        assert {0, 1, 4} <= {r.doc_id for r in docs.collect()}, name
    assert {r.doc_id for r in corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path)).collect()} >= {0, 1, 4}
