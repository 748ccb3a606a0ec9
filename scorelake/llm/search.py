"""Ranked lexical search: the best documents of every query, by MaxScore with bounds for pairs of terms.

Documents are read once.  Each task turns its own into blocks of inverted lists over the queries'
terms, written to the shared folder.  Numbers of documents, words and document frequencies are sums
over all blocks.  The index then adds, to each block, the largest impact of each term and, for each
pair of terms that are neighbours in some query's order, the largest joint impact of the documents
that hold both: so a pair has a list of the blocks in which it intersects, each with its joint maximum.

A query's terms are put in order of weight.  The bound of a set of terms is the least sum, over the
ways to match neighbours, of single maxima and pair maxima (the larger single maximum or the joint
one, whichever is more), which is never above the sum of single maxima and mostly far below it.  The
bounds serve three times: the best joint maxima of different blocks give each query's first
threshold; a block whose bound is below the threshold is skipped; and in a block only documents of
terms that the bound can't do without are candidates, which leave when their score and the bound of
the terms to come stay below the threshold.  Every block gives its best ``k`` documents of a query,
and a window over those (which keeps ``k`` a task before its shuffle) the best of all.  Only integers
are compared, so the rows are those of scoring every document.

Queries are taken in batches of some QUERY_TERMS terms, equal texts once; what goes to tasks or comes
to the driver is bounded by a batch.  Terms are compared by 64-bit hashes.

Defined results: null and empty texts have no terms; a query without terms, or whose terms no
document holds, has no rows; repeated query rows have their rows each; repeated documents rank each;
of equal scores the smaller id comes first and a null id last.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import drop_scratch, map_arrow, materialise
from ._text import NON_ALNUM, word_chunks

K = 20
#: Documents and list entries of a block at most (a longer document makes a larger one).
BLOCK_DOCS, BLOCK_ENTRIES = 16_384, 2_000_000
#: Terms of a batch of queries.
QUERY_TERMS = 200_000
#: Pairs are made of terms at most so many places apart in a query's order: the ones between may be missing in a block.
REACH = 2

ITEMS = "digest binary, terms array<long>, counts array<int>"
BLOCK = "ids array<long>, known array<boolean>, lengths array<long>, terms array<int>, starts array<int>, docs array<int>, tfs array<int>, documents long, words long"
INDEX = f"{BLOCK}, tops array<long>, pairs array<int>, joints array<long>, seeds array<long>"
FOUND = "item int, doc_id long, score long"


@dataclass(frozen=True)
class Batch:
    """A batch of queries: hashes of all terms, and of each query its terms (as places in ``vocabulary``) with their numbers."""

    vocabulary: np.ndarray
    terms: list[np.ndarray]
    counts: list[np.ndarray]


@dataclass(frozen=True)
class Weighted:
    """A batch with the corpus's numbers: terms in order of weight, and the pairs (low * size + high) that have joint maxima."""

    weights: np.ndarray
    documents: int
    words: int
    terms: list[np.ndarray]
    counts: list[np.ndarray]
    pairs: np.ndarray


def item_terms(items: DataFrame) -> DataFrame:
    """(digest, terms, counts) of each distinct text that has terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch.column(1), NON_ALNUM, True):
                found = [np.unique(words.hash[words.offsets[d] : words.offsets[d + 1]], return_counts=True) for d in range(len(words))]
                digests = batch.column(0).slice(row, len(words))
                yield pa.RecordBatch.from_arrays(
                    [digests, pa.array([t.view(np.int64) for t, _ in found], pa.list_(pa.int64())), pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32()))], names=["digest", "terms", "counts"]
                )

    texts = items.where("text is not null").select(F.unhex(F.sha2("text", 256)).alias("digest"), "text").dropDuplicates(["digest"])
    return map_arrow(texts, run, ITEMS).where("size(terms) > 0")


def build_blocks(docs: DataFrame, vocabulary: np.ndarray, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Inverted lists over ``vocabulary`` (sorted hashes), a row a block: of each term that occurs its documents' places and tf."""
    bits = np.uint64((1 << max(12, int(16 * len(vocabulary)).bit_length())) - 1)
    may = np.zeros(int(bits) + 1, bool)
    may[vocabulary & bits] = True

    def block(ids: list[pa.Array], lengths: list[np.ndarray], found: list[tuple], documents: int, words: int) -> pa.RecordBatch:
        terms, places, tfs = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        order = np.argsort(terms, kind="stable")  # documents came in order
        terms, starts = np.unique(terms[order], return_index=True)
        ids = pa.concat_arrays(ids) if ids else pa.array([], pa.int64())
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))
        lists = [
            one(ids.fill_null(0), pa.int64()), one(ids.is_valid(), pa.bool_()), one(np.concatenate(lengths) if lengths else [], pa.int64()), one(terms, pa.int32()),
            one(np.append(starts, len(order)), pa.int32()), one(places[order], pa.int32()), one(tfs[order], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays([*lists, pa.array([documents], pa.int64()), pa.array([words], pa.int64())], names=[c.split()[0] for c in BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, found, size, entries, documents, total = [], [], [], 0, 0, 0, 0
        for batch in batches:
            for row, words in word_chunks(batch.column(1), NON_ALNUM, True):
                n = np.diff(words.offsets)
                documents, total = documents + int((n > 0).sum()), total + int(n.sum())
                likely = np.flatnonzero(may[words.hash & bits])
                at = np.minimum(np.searchsorted(vocabulary, words.hash[likely]), len(vocabulary) - 1)
                same = vocabulary[at] == words.hash[likely]
                doc = np.searchsorted(words.offsets, likely[same], "right") - 1
                if len(doc):
                    # Documents without a term of the batch aren't listed.
                    own, place = np.unique(doc, return_inverse=True)
                    key, tf = np.unique(place * len(vocabulary) + at[same], return_counts=True)
                    ids.append(batch.column(0).take(pa.array(row + own)))
                    lengths.append(n[own])
                    found.append((key % len(vocabulary), size + key // len(vocabulary), tf))
                    size, entries = size + len(own), entries + len(key)
                if size >= block_docs or entries >= BLOCK_ENTRIES:
                    yield block(ids, lengths, found, documents, total)
                    ids, lengths, found, size, entries, documents, total = [], [], [], 0, 0, 0, 0
        if documents:
            yield block(ids, lengths, found, documents, total)

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, BLOCK)


def weigh(batch: Batch, blocks: DataFrame) -> Weighted | None:
    """The batch with term weights from the sums over all blocks; None if no document has a term."""
    sums = blocks.agg(F.sum("documents"), F.sum("words")).first()
    if not sums[0]:
        return None
    entries = blocks.select(F.inline(F.arrays_zip("terms", F.slice(F.col("starts"), 2, F.size("terms")).alias("ends"), F.slice("starts", 1, F.size("terms")).alias("starts"))))
    df = np.zeros(len(batch.vocabulary), np.int64)
    for row in entries.groupBy("terms").agg(F.sum(F.col("ends") - F.col("starts")).alias("df")).collect():  # at most the batch's terms
        df[row["terms"]] = row["df"]
    weights = np.array([math.floor(1000 * math.log((2 * sums[0] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    terms, counts, pairs = [], [], [np.zeros(0, np.int64)]
    for own, n in zip(batch.terms, batch.counts):
        order = np.lexsort((own, weights[own] * n))
        terms.append(own[order])
        counts.append(n[order])
        for reach in range(1, REACH + 1):
            a, b = own[order][:-reach], own[order][reach:]
            pairs.append(np.minimum(a, b) * len(weights) + np.maximum(a, b))
    return Weighted(weights, int(sums[0]), int(sums[1]), terms, counts, np.unique(np.concatenate(pairs)))


class Block:
    """One block's lists with the impacts of their entries; with bounds if it comes from the index."""

    def __init__(self, row: dict, queries: Weighted):
        self.queries, self.ids, self.known = queries, row["ids"], row["known"]
        self.terms, self.starts, self.docs = row["terms"], row["starts"], row["docs"]
        m = 75 + (25 * row["lengths"] * queries.documents) // queries.words
        tf = row["tfs"].astype(np.int64)
        self.impacts = np.repeat(queries.weights[self.terms], np.diff(self.starts)) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.docs]))
        self.tops, self.pairs, self.joints = row.get("tops"), row.get("pairs"), row.get("joints")

    def list_of(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.starts[place], self.starts[place + 1]
        return self.docs[lo:hi], self.impacts[lo:hi]

    def add_bounds(self) -> None:
        """Term maxima, and the joint maxima of the batch's pairs that intersect here."""
        self.tops = np.maximum.reduceat(self.impacts, self.starts[:-1]) if len(self.terms) else np.zeros(0, np.int64)
        size = len(self.queries.weights)
        here = np.zeros(size, bool)
        here[self.terms] = True
        both = np.flatnonzero(here[self.queries.pairs // size] & here[self.queries.pairs % size])
        kept, joints = [], []
        dense, last = np.zeros(len(self.ids), np.int64), -1
        for p in both:
            a, b = divmod(int(self.queries.pairs[p]), size)
            if a != last:
                dense[:] = -1
                docs, impacts = self.list_of(int(np.searchsorted(self.terms, a)))
                dense[docs] = impacts
                last = a
            docs, impacts = self.list_of(int(np.searchsorted(self.terms, b)))
            first = dense[docs]
            in_both = first >= 0
            if in_both.any():
                kept.append(p)
                joints.append(int((first[in_both] + impacts[in_both]).max()))
        self.pairs, self.joints = np.array(kept, np.int32), np.array(joints, np.int64)

    def bounds(self, item: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The item's terms here: places, numbers, bounds of the first 0, 1, 2 ... of them together, and a score that some document reaches."""
        own, counts = self.queries.terms[item], self.queries.counts[item].astype(np.int64)
        place = np.searchsorted(self.terms, own)
        here = np.flatnonzero((place < len(self.terms)) & (self.terms[np.minimum(place, len(self.terms) - 1)] == own)) if len(self.terms) else np.zeros(0, np.int64)
        place, counts, own = place[here], counts[here], own[here].astype(np.int64)
        tops = self.tops[place]
        caps = tops * counts
        together, reached = caps[:-1] + caps[1:], int(caps.max(initial=0))
        if len(own) > 1:
            # A pair that has joint maxima, but none in this block, doesn't intersect here.
            key = np.minimum(own[:-1], own[1:]) * len(self.queries.weights) + np.maximum(own[:-1], own[1:])
            number = np.minimum(np.searchsorted(self.queries.pairs, key), len(self.queries.pairs) - 1)
            paired = self.queries.pairs[number] == key
            joint = np.zeros(len(key), np.int64)
            if len(self.pairs):
                at = np.minimum(np.searchsorted(self.pairs, number), len(self.pairs) - 1)
                joint = np.where(self.pairs[at] == number, self.joints[at], 0)
            reached = max(reached, int(np.where(paired, joint, 0).max()))
            # More of a term than one adds at most its own maximum each time.
            most = np.where(joint > 0, joint + (caps - tops)[:-1] + (caps - tops)[1:], 0)
            together = np.where(paired, np.minimum(together, np.maximum(np.maximum(caps[:-1], caps[1:]), most)), together)
        upto = [0]
        for i, cap in enumerate(caps.tolist()):
            upto.append(min(upto[-1] + cap, upto[-2] + int(together[i - 1])) if i else cap)
        return place, counts, np.array(upto, np.int64), reached

    def best(self, item: int, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of documents, scores) of the best ``k`` that score at least ``least`` and above 0, ties by id included."""
        place, counts, upto, _ = self.bounds(item)
        none = np.zeros(0, np.int64)
        if not len(place) or upto[-1] < max(least, 1):
            return none, none
        free = int(np.searchsorted(np.maximum.accumulate(upto), max(least, 1), "left")) - 1  # terms that no candidate needs
        scores = np.zeros(len(self.ids), np.int64)
        for i in range(free, len(place)):
            docs, impacts = self.list_of(place[i])
            scores[docs] += counts[i] * impacts
        left = np.flatnonzero(scores)
        for i in range(free - 1, -1, -1):
            if not len(left):
                break
            if len(left) >= k:
                least = max(least, int(np.partition(scores[left], len(left) - k)[len(left) - k]))
            left = left[scores[left] + upto[i + 1] >= least]
            docs, impacts = self.list_of(place[i])
            at = np.minimum(np.searchsorted(docs, left), len(docs) - 1)
            scores[left] += np.where(docs[at] == left, counts[i] * impacts[at], 0)
        left = left[scores[left] >= max(least, 1)]
        order = np.lexsort((self.ids[left], ~self.known[left], -scores[left]))[:k]
        return left[order], scores[left[order]]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Each row's lists as arrays."""
    for i in range(batch.num_rows):
        yield {name: batch.column(j)[i].values.to_numpy(zero_copy_only=False) for j, name in enumerate(batch.schema.names) if pa.types.is_list(batch.schema.field(j).type)}


def build_index(blocks: DataFrame, queries: Weighted) -> DataFrame:
    """Blocks with term maxima, the joint maxima of pairs, and for each query a score that one of the block's documents reaches."""
    names = ["tops", "pairs", "joints", "seeds"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = {n: [] for n in names}
            for row in _rows(batch):
                block = Block(row, queries)
                block.add_bounds()
                seeds = np.array([block.bounds(i)[3] for i in range(len(queries.terms))], np.int64)
                for n, values in zip(names, (block.tops, block.pairs, block.joints, seeds)):
                    added[n].append(values)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(added[n], pa.list_(kind)) for n, kind in zip(names, kinds)]], names=[*batch.schema.names, *names])

    return map_arrow(blocks, run, INDEX)


def first_thresholds(index: DataFrame, items: int, k: int) -> np.ndarray:
    """Scores that at least ``k`` documents reach: the k-th largest of what different blocks' documents reach, else 0."""
    reached = index.select(F.posexplode("seeds").alias("item", "score"))
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    out = np.zeros(items, np.int64)
    for row in reached.withColumn("nth", nth).where(F.col("nth") == k).collect():  # a row a query of the batch
        out[row["item"]] = row["score"]
    return out


def search_blocks(index: DataFrame, queries: Weighted, least: np.ndarray, k: int) -> DataFrame:
    """(item, doc_id, score): the best ``k`` documents of each query in each block, but for those that can't be among the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                block, items, ids, known, scores = Block(row, queries), [], [], [], []
                for i in range(len(queries.terms)):
                    docs, found = block.best(i, int(least[i]), k)
                    items.append(np.full(len(docs), i, np.int32))
                    ids.append(block.ids[docs])
                    known.append(block.known[docs])
                    scores.append(found)
                ids = pa.array(np.concatenate(ids), pa.int64(), mask=~np.concatenate(known))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), ids, pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"])

    return map_arrow(index.drop("seeds"), run, FOUND)


def _batches(items: DataFrame, query_terms: int) -> Iterator[tuple[list[bytes], Batch]]:
    """Batches of queries, dealt by digest; one is on the driver at a time."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    number = -(-total // query_terms)
    for b in range(number):
        rows = items.where(F.pmod(F.xxhash64("digest"), F.lit(number)) == b).orderBy("digest").toArrow()
        if not rows.num_rows:
            continue
        terms = [np.array(x, np.int64).view(np.uint64) for x in rows["terms"].to_pylist()]
        vocabulary = np.unique(np.concatenate(terms))
        yield [bytes(x) for x in rows["digest"].to_pylist()], Batch(vocabulary, [np.searchsorted(vocabulary, t) for t in terms], [np.array(c, np.int64) for c in rows["counts"].to_pylist()])


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K, block_docs: int = BLOCK_DOCS, query_terms: int = QUERY_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the best ``k`` documents with a score above 0 for every row of ``items``."""
    spark = docs.sparkSession
    queries = materialise(item_terms(items), "search-items")
    parts = []
    for digests, batch in _batches(queries, query_terms):
        blocks = materialise(build_blocks(docs, batch.vocabulary, block_docs), "search-blocks")
        weighted = weigh(batch, blocks)
        if weighted is None:
            drop_scratch(spark, blocks)
            break
        index = materialise(build_index(blocks, weighted), "search-index")
        drop_scratch(spark, blocks)
        found = search_blocks(index, weighted, first_thresholds(index, len(digests), k), k)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        best = found.withColumn("rank", rank).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(digests)], "item int, digest binary")
        parts.append(materialise(best.join(F.broadcast(names), "item").select("digest", "rank", "doc_id", "score"), "search-best"))
        drop_scratch(spark, index)
    drop_scratch(spark, queries)
    if not parts:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    asked = items.where("text is not null").select("item_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    return asked.join(best, "digest").select("item_id", "rank", "doc_id", "score")
