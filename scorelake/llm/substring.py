"""Substring dedup by relative Lempel-Ziv parsing of window sequences against indexed blocks.

A text is the sequence of its windows of ``window`` words, each a symbol of its own (a hash), and
the windows of all texts are dealt to reference blocks by content: each belongs to the block of its
smallest word 8-gram, so equal windows, wherever they stand, meet in one block.  A block's
reference is the concatenation of the stretches of windows that it holds.  It is indexed by a
suffix order with the longest common prefixes of neighbours, and every stretch is factored
greedily from left to right: the next factor is the longest run of windows that also starts at
another place of the reference, and it names that place (document and window).  A factor of m
windows is m + window - 1 words long, so each of at least one window is sufficiently long.  As
symbols are whole windows, a window over the boundary of two factors is looked up by itself, and one
over the end of a stretch in its own block.  The factors of a document over all blocks merge to its
duplicate spans.

Only hashes move: per stretch one row with 6 bytes a window.  They are folded with the block's
64-bit hash into one 64-bit key, and windows count as equal when these 64 bits agree.  Blocks are
read in order and indexed a few at a time, so a task holds ``index_windows`` windows or one block.
Blocks that are common (in at least ``hot_share`` of all documents; a list that the share bounds)
are split by window: of each window a task sends one row, and refers its other places to that one
itself, so that a passage in a third of all documents sends one row a task and window.  There every
factor is a single window (neighbours merge when spans do), not the longest match.

Windows are judged on the input.  Nulls and texts shorter than a window are kept whole; very long
texts are used whole; repeated rows are copies of each other, and rows equal in id and text share
their spans, which are equal; an empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._heavy import FOLD_AT, heavy_values
from ._spark import map_arrow
from ._text import SPACE, grams, mix, sliding_min, word_chunks

WINDOW = 35
SEED = 8
HOT_SHARE = 0.01
WIDTH = 6
INDEX_WINDOWS = 2_000_000


def _windows(h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and block of every window of a document's words."""
    return grams(h, window), sliding_min(grams(h, min(seed, window)), window - min(seed, window) + 1)


def _stretches(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    return first, np.concatenate([first[1:], [len(block)]])


def hot_blocks(docs: DataFrame, window: int = WINDOW, seed: int = SEED, share: float = HOT_SHARE) -> np.ndarray:
    """Blocks with a stretch in at least ``share`` of all documents."""

    def blocks(words, d):
        h = words.hash[words.offsets[d] : words.offsets[d + 1]]
        return np.unique(_windows(h, window, seed)[1]) if len(h) >= window else h[:0]

    return heavy_values(docs, SPACE, False, blocks, share, FOLD_AT)[0]


def _key():
    """The id, with a stand-in for null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))


STRETCH = "route long, doc_id long, digest long, first int, n int, many boolean, windows binary"
STRETCH_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
#: A factor that its task has found already: no windows, and its reference.
FOUND = ", reference long, reference_first int"
FOUND_TYPES = (pa.int64(), pa.int32())


def _pack(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH])


def _rows(columns: list, schema: str, types: tuple) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def duplicate_factors(docs: DataFrame, window: int = WINDOW, seed: int = SEED, share: float = HOT_SHARE, index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """(doc_id, digest, first, n, reference, reference_first): the n windows from ``first`` also start, in this order, from a window of document ``reference``."""
    shared = docs.sparkSession.sparkContext.broadcast(hot_blocks(docs, window, seed, share))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        hot_held: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            doc_ids, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, words in word_chunks(batch.column(1), SPACE):
                out: list[tuple] = []
                for d in range(len(words)):
                    h = words.hash[words.offsets[d] : words.offsets[d + 1]]
                    if len(h) < window:
                        continue
                    whole, block = _windows(h, window, seed)
                    first, end = _stretches(block)
                    keys = block[first]
                    is_hot = np.isin(keys, hot) if len(hot) else np.zeros(len(keys), bool)
                    if is_hot.any():
                        at = np.concatenate([np.arange(a, b) for a, b in zip(first[is_hot], end[is_hot])])
                        hot_held.append((whole[at], block[at], at, np.full(len(at), doc_ids[row + d]), np.full(len(at), digests[row + d])))
                        held += len(at)
                    raw = _pack(whole).tobytes()
                    for k, a, b in zip(keys[~is_hot].view(np.int64).tolist(), first[~is_hot].tolist(), end[~is_hot].tolist()):
                        out.append((k, doc_ids[row + d], digests[row + d], a, b - a, False, raw[a * WIDTH : b * WIDTH], None, None))
                if out:
                    yield _rows([list(c) for c in zip(*out)], STRETCH + FOUND, STRETCH_TYPES + FOUND_TYPES)
                if held > index_windows:
                    yield from _hot_rows(*(np.concatenate(c) for c in zip(*hot_held)))
                    hot_held, held = [], 0
        if hot_held:
            yield from _hot_rows(*(np.concatenate(c) for c in zip(*hot_held)))

    docs = docs.select(_key().alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    stretches = map_arrow(docs, emit, STRETCH + FOUND)
    return map_arrow(stretches.repartition("route").sortWithinPartitions("route"), _factor_blocks(index_windows), FACTOR)


def _hot_rows(whole: np.ndarray, block: np.ndarray, at: np.ndarray, doc_id: np.ndarray, digest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Windows of common blocks, each on a route of its own: one row for each different window, and a factor for each place of those met twice."""
    route = mix(block + mix(whole))
    order = np.lexsort((whole, route))
    same = np.concatenate([[False], (route[order][1:] == route[order][:-1]) & (whole[order][1:] == whole[order][:-1])])
    head = np.flatnonzero(~same)
    group = np.cumsum(~same) - 1
    size = np.bincount(group)
    chosen = order[head]
    raw = _pack(whole[chosen])
    n = len(chosen)
    for a in range(0, n, 20_000):
        c, few = chosen[a : a + 20_000], slice(a, a + 20_000)
        columns = [route[c].view(np.int64), doc_id[c].astype(np.int64), digest[c].astype(np.int64), at[c].astype(np.int32), np.ones(len(c), np.int32), size[few] > 1, [r.tobytes() for r in raw[few]], [None] * len(c), [None] * len(c)]
        yield _rows(columns, STRETCH + FOUND, STRETCH_TYPES + FOUND_TYPES)
    # Each place of a window met twice refers to the group's first place, and that to the second; runs of one reference are one factor.
    again = np.flatnonzero(size[group] > 1)
    if not len(again):
        return
    lead = head[group[again]]
    known, other = order[again], order[np.where(lead == again, lead + 1, lead)]
    sort = np.lexsort((at[known], digest[known].astype(np.int64), doc_id[known].astype(np.int64)))
    known, other = known[sort], other[sort]
    d, g, p, to, to_p = doc_id[known].astype(np.int64), digest[known].astype(np.int64), at[known], doc_id[other].astype(np.int64), at[other]
    follows = (d[1:] == d[:-1]) & (g[1:] == g[:-1]) & (p[1:] == p[:-1] + 1) & (to[1:] == to[:-1]) & (to_p[1:] == to_p[:-1] + 1)
    first = np.flatnonzero(np.concatenate([[True], ~follows]))
    length = np.diff(np.concatenate([first, [len(p)]]))
    n = len(first)
    spread = mix(d[first].astype(np.uint64) + mix(p[first].astype(np.uint64))).view(np.int64)
    yield _rows([spread, d[first], g[first], p[first].astype(np.int32), length.astype(np.int32), np.zeros(n, bool), [b""] * n, to[first], to_p[first].astype(np.int32)], STRETCH + FOUND, STRETCH_TYPES + FOUND_TYPES)


FACTOR = "doc_id long, digest long, first int, n int" + FOUND


def _factor_blocks(index_windows: int):
    """Factors of the stretches of each block; rows come sorted by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            known = pa.compute.equal(pa.compute.binary_length(batch.column(6)), 0)
            done = batch.filter(known)
            if done.num_rows:
                yield pa.RecordBatch.from_arrays([done.column(i) for i in (1, 2, 3, 4, 7, 8)], names=[c.split()[0] for c in FACTOR.split(", ")])
            rest = batch.filter(pa.compute.invert(known))
            if rest.num_rows:
                held.append(rest)
                size += pa.compute.sum(rest.column(4)).as_py()
            if size > index_windows:
                # The last block may go on in the next batch.
                table = pa.Table.from_batches(held).combine_chunks()
                route = table.column("route").to_numpy()
                end = int(np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))[-1])
                if end:
                    yield from factor(table.slice(0, end))
                    held = table.slice(end).to_batches()
                    size = pa.compute.sum(table.column("n").slice(end)).as_py()
        if held:
            yield from factor(pa.Table.from_batches(held).combine_chunks())

    def factor(table: pa.Table) -> Iterator[pa.RecordBatch]:
        route = table.column("route").to_numpy().view(np.uint64)
        count = table.column("n").to_numpy().astype(np.int64)
        many = table.column("many").to_numpy(zero_copy_only=False)
        packed = np.frombuffer(b"".join(x for c in table.column("windows").chunks for x in c.to_pylist()), np.uint8).reshape(-1, WIDTH)
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, :WIDTH] = packed
        key = mix(wide.view("<u8").ravel() + np.repeat(mix(route), count))
        stretch = np.repeat(np.arange(len(count)), count)
        at, length, source = greedy_factors(key, stretch)
        owner = stretch[at]
        keep = ~many[owner]  # a row that stands for several has been answered in its task
        at, length, source, owner = at[keep], length[keep], source[keep], owner[keep]
        begin = np.cumsum(count) - count
        first, doc_id, digest = (table.column(c).to_numpy() for c in ("first", "doc_id", "digest"))
        other = stretch[source]
        columns = [doc_id[owner], digest[owner], first[owner] + at - begin[owner], length, doc_id[other], first[other] + source - begin[other]]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), *FOUND_TYPES)
        yield _rows([c.astype(t.to_pandas_dtype()) for c, t in zip(columns, types)], FACTOR, types)

    return run


def greedy_factors(key: np.ndarray, stretch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, place of the match) of the factors of every stretch of a block's reference ``key``.

    Symbols that stand once match nothing, so only runs of others are put in suffix order.
    """
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    often = np.zeros(len(key), bool)
    often[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    place = np.flatnonzero(often)
    m = len(place)
    if not m:
        return place, place, place
    symbol = np.empty(len(key), np.int64)
    symbol[order] = np.cumsum(np.concatenate([[0], ~same]))
    joined = np.zeros(m, bool)  # whether a symbol goes on the run of the one before
    joined[1:] = (place[1:] == place[:-1] + 1) & (stretch[place[1:]] == stretch[place[:-1]])
    run_end = np.append(np.flatnonzero(~joined)[1:], m)[np.cumsum(~joined) - 1]
    # Prefix doubling: ranks of the 2^k symbols from each place, -1 where the run is shorter.
    ranks = [np.unique(symbol[place], return_inverse=True)[1].ravel().astype(np.int64)]
    step = 1
    while True:
        fits = np.arange(m) + 2 * step <= run_end
        if not fits.any():
            break
        i = np.flatnonzero(fits)
        rank = np.full(m, -1, np.int64)
        rank[i] = np.unique(ranks[-1][i] * np.int64(m + 1) + ranks[-1][i + step], return_inverse=True)[1].ravel()
        if len(i) == rank.max() + 1:  # no two places agree on so many symbols
            break
        ranks.append(rank)
        step *= 2
    suffix = _suffix_order(ranks, run_end, m)
    left = _common(ranks, run_end, suffix[:-1], suffix[1:])
    back, ahead = np.zeros(m, np.int64), np.zeros(m, np.int64)
    back[suffix[1:]], ahead[suffix[:-1]] = left, left
    before, after = np.zeros(m, np.int64), np.zeros(m, np.int64)
    before[suffix[1:]], after[suffix[:-1]] = suffix[:-1], suffix[1:]
    longest, source = np.maximum(back, ahead), np.where(back >= ahead, before, after)
    # All stretches are factored side by side, one factor a turn.
    at, found = np.flatnonzero(~joined), []
    while len(at):
        found.append(at)
        at = at + longest[at]
        last = run_end[found[-1]]
        at = at[at < last]
    at = np.concatenate(found)
    return place[at], longest[at], place[source[at]]


def _suffix_order(ranks: list[np.ndarray], run_end: np.ndarray, m: int) -> np.ndarray:
    """Places in the order of the symbols from each to its run's end."""
    rank = ranks[0]
    step = 1
    for _ in range(len(ranks)):
        later = np.zeros(m, np.int64)
        fits = np.flatnonzero(np.arange(m) + step < run_end)
        later[fits] = rank[fits + step] + 1
        rank = np.unique(rank * np.int64(m + 1) + later, return_inverse=True)[1].ravel().astype(np.int64)
        step *= 2
    return np.argsort(rank, kind="stable")


def _common(ranks: list[np.ndarray], run_end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols from the places ``a`` and ``b`` agree."""
    total = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + total, b + total
        inside = (x < run_end[a]) & (y < run_end[b])
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        agree = inside & (ranks[k][x] == ranks[k][y]) & (ranks[k][x] >= 0)
        total[agree] += 1 << k
    return total


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, share: float = HOT_SHARE, index_windows: int = INDEX_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space)."""
    factors = duplicate_factors(docs, window, seed, share, index_windows)
    spans = factors.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("first", "n")).alias("factors"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), _key().alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    joined = rows.alias("d").join(spans.alias("s"), ["doc_id", "digest"], "left")
    joined = joined.select("d.id", "d.text", F.col("s.factors.first").alias("firsts"), F.col("s.factors.n").alias("ns"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, ns = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            n_words, n_removed, kept = [], [], []
            for row, words in word_chunks(batch.column(1), SPACE):
                for d in range(len(words)):
                    lo, hi = words.offsets[d], words.offsets[d + 1]
                    gone = np.zeros(hi - lo + 1, np.int64)
                    if firsts[row + d]:
                        np.add.at(gone, firsts[row + d], 1)
                        np.add.at(gone, np.array(firsts[row + d]) + np.array(ns[row + d]) + window - 1, -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    n_words.append(int(hi - lo))
                    n_removed.append(int(hi - lo - stay.sum()))
                    base = words.bounds[d]
                    raw = words.data[base : words.bounds[d + 1]].tobytes()
                    kept.append(b" ".join([raw[a:b] for a, b in zip((words.start[lo:hi][stay] - base).tolist(), (words.end[lo:hi][stay] - base).tolist())]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return map_arrow(joined, cut, "doc_id long, n_words long, n_removed long, kept string")


def digest_columns(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
