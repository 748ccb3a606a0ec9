"""Benchmark decontamination with an FM-index per training shard.

Each task turns the texts it reads into shards of ``shard_bytes`` and builds one FM-index per
shard: suffix order by prefix doubling, the Burrows-Wheeler string in a wavelet matrix, and
sampled suffix positions.  Every window of the test items is a phrase that is searched backwards
through wavelet ranks; its occurrences are located from the sampled positions, and overlapping
occurrences merge to removal spans.  Document words that no item uses, and stretches of item words
shorter than every phrase, can't be part of an occurrence: the index holds one separator for them.

Texts don't move: no shuffle.  Test items are a stated query set; they are collected in blocks of
at most ``block_bytes`` and a set larger than that is searched block by block.

Nulls, empty texts and items without words have no words and no hits; repeated rows each get their
own result; an item that occurs twice under one id counts once, one without an id is searched but not
named; an empty table gives no rows.  Very long texts are a shard of their own.
Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import fresh, map_arrow, materialise
from ._text import NON_ALNUM, Words, chunks, segment

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
SAMPLE_EVERY = 8


class WaveletMatrix:
    """Rank and access over symbols below ``2 ** bits``, for arrays of positions at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``end``."""
        low = np.zeros_like(end)
        for level, ones, zeros in self.levels:
            bit = (symbol >> level) & 1 == 1
            e, b = ones[end], ones[low]
            end, low = np.where(bit, zeros + e, end - e), np.where(bit, zeros + b, low - b)
        return end - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands before."""
        low, symbol = np.zeros_like(at), np.zeros_like(at)
        for level, ones, zeros in self.levels:
            e, b = ones[at], ones[low]
            bit = ones[at + 1] > e
            symbol = symbol | (bit.astype(np.int64) << level)
            at, low = np.where(bit, zeros + e, at - e), np.where(bit, zeros + b, low - b)
        return symbol, at - low


class FMIndex:
    """Index of a symbol string in which 0 separates stretches; phrases don't hold 0."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        n = len(symbols)
        order = self._suffix_order(symbols)
        before = symbols[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        self.ranks = WaveletMatrix(before, max(1, int(sigma - 1).bit_length()))
        self.sampled = (order % SAMPLE_EVERY == 0) | (before == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]
        self.n = n

    @staticmethod
    def _suffix_order(symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        is_zero = symbols == 0
        zeros = int(is_zero.sum())
        # Each separator gets a rank of its own, so no comparison runs past one.
        rank = np.where(is_zero, np.cumsum(is_zero) - 1, zeros + symbols).astype(np.int64)
        step = 1
        while True:
            later = np.zeros(n, np.int64)
            later[: n - step] = rank[step:] + 1
            key = rank * np.int64(max(n, int(rank.max()) + 1) + 2) + later
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1:
                return order
            step *= 2

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each phrase (rows right-aligned in ``phrases``)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for back in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, phrases.shape[1] - 1 - back]
            low[live] = self.first[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.ranks.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of suffixes: walk back to the nearest sampled one."""
        at, walked, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            done = self.sampled[at[todo]]
            hit = todo[done]
            out[hit] = self.samples[self.sample_rank[at[hit]]] + walked[hit]
            todo = todo[~done]
            if len(todo):
                symbol, before = self.ranks.access(at[todo])
                at[todo] = self.first[symbol] + before
                walked[todo] += 1
        return out


class Phrases:
    """Windows of the test items as rows of word codes, each with the items that hold it."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        data = np.frombuffer(b"".join(t for _, t in items), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(t) for _, t in items])]).astype(np.int64)
        words = segment(data, bounds, NON_ALNUM, True)
        self.window = window
        self.vocabulary, code = np.unique(words.hash, return_inverse=True)
        self.sigma = len(self.vocabulary) + 1
        rows, lengths, owners = [], [], []
        for i in range(len(items)):
            own = code[words.offsets[i] : words.offsets[i + 1]].astype(np.int64) + 1
            width = min(window, len(own))
            if width:
                view = np.lib.stride_tricks.sliding_window_view(own, width)
                rows.append(np.pad(view, ((0, 0), (window - width, 0))))
                lengths.append(np.full(len(view), width))
                owners.append(np.full(len(view), i))
        if not rows:
            self.rows, self.lengths = np.zeros((0, window), np.int64), np.zeros(0, np.int64)
            self.owners, self.owner_of, self.ids = np.zeros(0, np.int64), np.zeros(1, np.int64), []
            return
        every, all_owners = np.concatenate(rows), np.concatenate(owners)
        self.rows, inverse = np.unique(every, axis=0, return_inverse=True)
        self.lengths = (self.rows > 0).sum(axis=1)
        pairs = np.unique(np.stack([inverse.ravel(), all_owners], axis=1), axis=0)
        self.owners = pairs[:, 1]
        self.owner_of = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.ids = [i for i, _ in items]


def _codes(words: Words, vocabulary: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(len(words.hash), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words.hash), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words.hash, at + 1, 0)


def _occurrences(shard: list[Words], phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word position in the shard, phrase) of every occurrence inside one document."""
    none = np.zeros(0, np.int64)
    if not len(phrases.rows):
        return none, none
    codes, base, ends = [_codes(w, phrases.vocabulary) for w in shard], 0, []
    for w in shard:
        ends.append(w.offsets[:-1] + base)
        base += len(w.hash)
    code, doc_start = np.concatenate(codes), np.concatenate(ends)
    # Stretches of item words within a document; only those as long as the shortest phrase matter.
    edge = np.zeros(base + 1, bool)
    edge[doc_start] = True
    known = code > 0
    begins = known & np.concatenate([[True], ~known[:-1]]) | known & edge[:-1]
    first = np.flatnonzero(begins)
    if not len(first):
        return none, none
    stops = known & (np.concatenate([~known[1:], [True]]) | edge[1:])
    length = np.flatnonzero(stops) + 1 - first
    keep = length >= int(phrases.lengths.min())
    first, length = first[keep], length[keep]
    if not len(first):
        return none, none
    # A separator stands before each stretch.
    total = int((length + 1).sum())
    start = np.cumsum(length + 1) - length
    symbols, origin = np.zeros(total + 1, np.int64), np.zeros(total + 1, np.int64)
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    to, source = np.repeat(start, length) + within, np.repeat(first, length) + within
    symbols[to], origin[to] = code[source], source
    index = FMIndex(symbols, phrases.sigma)
    low, high = index.search(phrases.rows, phrases.lengths)
    count = high - low
    found = np.repeat(np.arange(len(low)), count)
    rows = np.repeat(low, count) + np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
    return origin[index.locate(rows)], found


def _search_shard(shard: list[Words], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str], Words, int]]:
    """Per document: word count, merged hit spans (words), sorted item ids, its Words and number there."""
    at, phrase = _occurrences(shard, phrases)
    order = np.argsort(at, kind="stable")
    at, phrase = at[order], phrase[order]
    out, base = [], 0
    for words in shard:
        bounds = np.searchsorted(at, words.offsets + base)
        for doc in range(len(words)):
            lo, hi = bounds[doc], bounds[doc + 1]
            spans, ids = [], []
            if hi > lo:
                begin = at[lo:hi] - base - words.offsets[doc]
                stop = begin + phrases.lengths[phrase[lo:hi]]
                reach = np.maximum.accumulate(stop)
                new = np.concatenate([[True], begin[1:] > reach[:-1]])
                last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(begin) - 1]])
                spans = list(zip(begin[new].tolist(), reach[last].tolist()))
                items = {i for p in np.unique(phrase[lo:hi]) for i in phrases.owners[phrases.owner_of[p] : phrases.owner_of[p + 1]].tolist()}
                ids = sorted({phrases.ids[i] for i in items if phrases.ids[i] is not None})
            out.append((int(words.offsets[doc + 1] - words.offsets[doc]), spans, ids, words, doc))
        base += len(words.hash)
    return out


def _without(words: Words, doc: int, spans: list[tuple[int, int]]) -> str:
    base, first = words.bounds[doc], words.offsets[doc]
    raw = words.data[base : words.bounds[doc + 1]].tobytes()
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : words.start[first + a] - base])
        at = words.end[first + b - 1] - base
    return b"".join([*out, raw[at:]]).decode()


SPANS = "array<struct<first:int,end:int>>"
RESULT = {"n_words": "bigint", "spans": SPANS, "items": "array<string>"}


def _pass(docs: DataFrame, items: list[tuple[str, bytes]], window: int, shard_bytes: int, remove: bool) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in RESULT]
    names = [f.name for f in kept]
    docs = docs.select(*[F.col(f"`{n}`") for n in names])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{k} {v}" for k, v in RESULT.items())])
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(items, window)

        def flush(shard: list[Words], rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = _search_shard(shard, phrases)
            table = pa.Table.from_batches(rows).combine_chunks()
            columns = {n: table.column(n) for n in names}
            if remove:
                texts = table.column("text").to_pylist()
                for i, (_, spans, _, words, doc) in enumerate(found):
                    if spans:
                        texts[i] = _without(words, doc, spans)
                columns["text"] = pa.array(texts, pa.string())
            columns["n_words"] = pa.array([x[0] for x in found], pa.int64())
            columns["spans"] = pa.array([[{"first": a, "end": b} for a, b in x[1]] for x in found], span_type)
            columns["items"] = pa.array([x[2] for x in found], pa.list_(pa.string()))
            return pa.table(columns).combine_chunks().to_batches()

        shard, rows, held = [], [], 0
        for batch in batches:
            for row, end, data, bounds in chunks(batch.column(names.index("text"))):
                shard.append(segment(data, bounds, NON_ALNUM, True))
                rows.append(batch.slice(row, end - row))
                held += len(data)
                if held >= shard_bytes:
                    yield from flush(shard, rows)
                    shard, rows, held = [], [], 0
        if rows:
            yield from flush(shard, rows)

    return map_arrow(docs, search, schema)


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES, remove: bool = False
) -> DataFrame:
    """``docs`` with n_words, spans (merged hits, in words) and items (ids of items that occur).

    With ``remove`` the hit spans are cut from ``text``.  Items beyond ``block_bytes`` are searched
    in several passes over the documents; each pass searches the whole text as it came in.
    """
    known = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text"))
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    if n_blocks == 1:
        block = [(r.id, bytes(r.text)) for r in known.collect()]
        return _pass(docs, block, window, shard_bytes, remove)
    row, spans = fresh(docs.columns, "_row"), fresh(docs.columns, "_spans")
    keyed = materialise(docs.withColumn(row, F.expr("uuid()")), "decontaminate-rows")
    found = None
    for i in range(n_blocks):
        # Blocks of near-equal size: items are dealt by a hash of their id and text.
        block = [(r.id, bytes(r.text)) for r in known.where(F.expr(f"pmod(xxhash64(id, text), {n_blocks}) = {i}")).collect()]
        part = _pass(keyed.select(row, "text"), block, window, shard_bytes, False).drop("text")
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy(row).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias(spans), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    joined = keyed.drop(*RESULT).join(merged, row).drop(row)
    return _merge_spans(joined, spans, remove)


def _merge_spans(df: DataFrame, found: str, remove: bool) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != found]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"spans {SPANS}"])

    def merge(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                spans = []
                for s in sorted((s["first"], s["end"]) for s in r.pop(found)):
                    if spans and s[0] <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], s[1]))
                    else:
                        spans.append(s)
                r["spans"] = [{"first": a, "end": b} for a, b in spans]
                if remove and spans:
                    raw = np.frombuffer(r["text"].encode(), np.uint8)
                    r["text"] = _without(segment(raw, np.array([0, len(raw)]), NON_ALNUM, True), 0, spans)
            target = pa.schema([*(f for f in batch.schema if f.name != found), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))])
            yield pa.RecordBatch.from_pylist(rows, schema=target)

    return map_arrow(df, merge, schema)


def digest_columns(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
