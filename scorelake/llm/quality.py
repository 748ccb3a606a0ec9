"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its words and character n-grams, hashed to
``buckets`` rows, followed by a softmax layer: the usual bag-of-subwords classifier, trained by
numpy stochastic gradient descent with a linearly falling rate.  As the model is linear in the
averaged vectors, scoring adds one number per feature (the row times the class difference), which
gives the same result as averaging first.

Training takes at most ``max_train`` labelled rows, those with the smallest hash of their id; the
sample is all that reaches the driver.  Scoring reads whole texts where they are: no shuffle.
Null and empty texts have no features and get the score of the bias; rows without a label, with
a null label or with contradicting labels aren't trained on; with no usable label, as in an empty
table, every score is 0.5.  Columns that aren't asked for are ignored, an input column ``score`` is
replaced.

One feature is made by hand: a word said twice in a row is the same feature whatever the word.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_arrow
from ._text import SPACE, chunks, mix, segment

BUCKETS = 1 << 18
DIM = 16
MAX_TRAIN = 1_500
EPOCHS = 4
RATE = 0.5
CHAR_GRAMS = (3, 5)
CHUNK_BYTES = 256 << 10
REPEATED = np.uint64(0x5EED)


def feature_ids(data: np.ndarray, bounds: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every feature: each word (as written), each pair of words, and character 3- and 5-grams."""
    words = segment(data, bounds, SPACE, False)
    doc_of_word = np.repeat(np.arange(len(words)), np.diff(words.offsets))
    same = doc_of_word[1:] == doc_of_word[:-1]
    pairs = mix(words.hash[:-1] * np.uint64(3) + words.hash[1:])[same]
    # A word said twice in a row is one feature whatever the word.
    pairs[(words.hash[:-1] == words.hash[1:])[same]] = REPEATED
    ids, owner = [words.hash, pairs], [doc_of_word, doc_of_word[:-1][same]]
    if len(data):
        doc_of_byte = np.repeat(np.arange(len(words)), np.diff(bounds))
        value = data.astype(np.uint64)
        for n in CHAR_GRAMS:
            size = len(data) - n + 1
            if size > 0:
                gram = np.full(size, n, np.uint64)
                for i in range(n):
                    gram = gram * np.uint64(257) + value[i : i + size]
                inside = doc_of_byte[:size] == doc_of_byte[n - 1 :]
                ids.append(mix(gram[inside]))
                owner.append(doc_of_byte[:size][inside])
    return (np.concatenate(ids) & np.uint64(buckets - 1)).astype(np.int64), np.concatenate(owner)


class Model:
    """``weight``: per bucket the difference of the two classes' logits; ``bias``: its constant."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        ids, owner = feature_ids(data, bounds, len(self.weight))
        n = len(bounds) - 1
        total = np.bincount(owner, self.weight[ids], n)
        count = np.bincount(owner, minlength=n)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -60, 60)))


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """SGD over documents, each given as (distinct buckets, shares that sum to 1)."""
    rng = np.random.default_rng(seed)
    table = (rng.random((buckets, dim), np.float32) * 2 - 1) / np.float32(dim)
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    # The rare class weighs more, so that it is learned too.
    weight = np.sqrt(np.where(labels == 1, len(labels) / max(1, 2 * (labels == 1).sum()), len(labels) / max(1, 2 * (labels == 0).sum())))
    steps, step = epochs * len(features), 0
    for _ in range(epochs):
        for i in rng.permutation(len(features)):
            ids, share = features[i]
            speed = rate * (1 - step / steps) * weight[i]
            step += 1
            rows = table[ids]
            hidden = share @ rows
            logit = hidden @ out + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= np.float32(speed) * np.outer(hidden, p)
            bias -= np.float32(speed * 0.1) * p
            # The gradient of an average is shared out; scaling by the number of features keeps rare ones learning.
            table[ids] = rows - np.float32(speed) * np.outer(share * np.float32(np.sqrt(len(ids))), back)
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id):
    """Rows that training never sees; a null id isn't one of them, but never has a label either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(quality, text) of a bounded sample: the labelled, not held-out rows whose ids hash smallest; repeated rows count once."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
    known = known.where((F.col("quality") == F.col("_most")) & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("_digest"))
    # At most ``max_train`` short rows each: small enough to broadcast by their bound.
    several = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "_digest", "quality").distinct()
    rows = several.orderBy(F.xxhash64("doc_id"), "doc_id", "_digest").limit(max_train)
    return docs.join(F.broadcast(rows), ["doc_id", "_digest"]).groupBy("doc_id", "_digest", "quality").agg(F.first("text").alias("text")).select("quality", "text")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, buckets: int = BUCKETS) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality = batch.column(0).to_pylist()
            rows = []
            for row, end, data, bounds in chunks(batch.column(1), CHUNK_BYTES):
                ids, owner = feature_ids(data, bounds, buckets)
                order = np.argsort(owner, kind="stable")
                ids, cut = ids[order], np.searchsorted(owner[order], np.arange(end - row + 1))
                for i in range(end - row):
                    distinct, times = np.unique(ids[cut[i] : cut[i + 1]], return_counts=True)
                    rows.append((quality[row + i], distinct.astype("<i4").tobytes(), times.astype("<i4").tobytes()))
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], names=["quality", "ids", "times"])

    sample = map_arrow(training_rows(docs, labels, max_train), count, "quality int, ids binary, times binary")
    # A bounded table; the order of its rows is made to depend on them alone.
    found = sample.toPandas()
    rows = []
    for label, raw, counts in zip(found["quality"], found["ids"], found["times"]):
        ids, times = np.frombuffer(raw, "<i4"), np.frombuffer(counts, "<i4").astype(np.float32)
        if len(ids):
            rows.append((zlib.crc32(raw), int(label), ids, times / times.sum()))
    del found
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    features, target = [r[2:] for r in rows], [r[1] for r in rows]
    if len(set(target)) < 2:
        return Model(np.zeros(buckets, np.float32), 0.0)
    return train(features, np.array(target), buckets)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``score``; the model is a table of fixed size."""
    fields = [f for f in docs.schema.fields if f.name in keep and f.name != "score"]
    names = [f.name for f in fields]
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double"])

    # A text that is kept isn't sent twice.
    sent = [*names, *([] if "text" in names else ["text"])]
    text_at = sent.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(data, bounds) for _, _, data, bounds in chunks(batch.column(text_at), CHUNK_BYTES)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(scores, pa.float64())], names=[*names, "score"])

    return map_arrow(docs.select(*[F.col(f"`{n}`") for n in sent]), run, schema)
