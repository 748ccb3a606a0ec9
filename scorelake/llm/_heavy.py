"""Values that stand in a large share of all documents, found without counting every value."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import drop_scratch, map_arrow, materialise
from ._text import Words, word_chunks

FOLD_AT = 1_000_000


class LossyCounter:
    """Counts of values given in arrays; what is rarer than one a fold is forgotten, so memory stays bounded."""

    def __init__(self):
        self.values, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.size, self.folds = 0, 0

    def add(self, values: np.ndarray) -> None:
        self.held.append(values)
        self.size += len(values)

    def fold(self) -> None:
        new, n = np.unique(np.concatenate([self.values, *self.held]), return_counts=True)
        n = n.astype(np.int64)
        old = np.searchsorted(new, self.values)
        n[old] += self.counts - 1
        fresh = np.ones(len(new), bool)
        fresh[old] = False
        n[fresh] += self.folds
        self.folds += 1
        often = n > self.folds
        self.values, self.counts, self.held, self.size = new[often], n[often], [], 0


def heavy_values(docs: DataFrame, separators: np.ndarray, lower: bool, values_of: Callable[[Words, int], np.ndarray], share: float, fold_at: int = FOLD_AT) -> tuple[np.ndarray, np.ndarray]:
    """Values (distinct per document, from ``text``) in at least ``share`` of all documents, and about how often they stand.

    A value that common is so in some task's share of the documents.  Tasks count with half the
    share as their limit, so the sum over tasks lacks less than the other half, and what reaches the
    driver is bounded by the values of two average documents over the share, however many tasks
    there are.  Tasks of few documents can miss a value: use the list where a miss costs time only.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, documents = LossyCounter(), 0
        for batch in batches:
            for _, words in word_chunks(batch.column(0), separators, lower):
                documents += len(words)
                for d in range(len(words)):
                    counter.add(values_of(words, d))
                if counter.size > fold_at:
                    counter.fold()
        if documents:
            counter.fold()
            keep = counter.counts >= max(4, share / 2 * documents)
            # The task's documents come in a row of their own, without a value.
            values, n = [None, *counter.values[keep].view(np.int64).tolist()], [documents, *counter.counts[keep].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(n, pa.int64())], names=["value", "n"])

    counted = materialise(map_arrow(docs.select("text"), count, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")), "heavy-values")
    documents = counted.where("value is null").select("n").first()
    rows = counted.where(F.col("value").isNotNull() & (F.col("n") >= share / 2 * (documents["n"] if documents else 0))).toPandas()
    drop_scratch(docs.sparkSession, counted)
    values, n = rows["value"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(values)
    return values[order], n[order]
