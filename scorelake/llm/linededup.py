"""Line dedup by winnowing over line hashes.

A document is its sequence of lines; blank ones are skipped.  Of each window of ``min_lines``
consecutive lines the line with the smallest hash is selected, so two copies of a window always
select the same line of it, and a line is a fingerprint if some window selects it.  A fingerprint is one
row, however many windows select it (about two rows for every ``min_lines`` + 1 lines), and those
that stand once go no further.  Positions of the
others are joined by fingerprint, and matches are extended to both sides: each window that selected the line
tells how far to the left and right of it the lines agree, and the first position with the same
lines around the fingerprint stays; the lines of the windows at all others are later repeats.  A longer
repeat holds a selected line in each of its windows, so the windows' union is the whole of it.  Lines of at least ``long_words`` words are fingerprints of
their own and repeat alone.  The first place (by document, then line) stays, all later copies go.

A common line never meets its copies pairwise: positions are grouped by fingerprint and match with
partial sums of the first place.  Fingerprints of more than ``hot_share`` of all positions are dealt
by match as well, and matches that are as common get their first place by a broadcast table, which
has at most ``min_lines`` / ``hot_share`` rows.  Only hashes move until the lines are cut.

Nulls stay null and texts without repeats stay as they are, however long; rows of equal id and
text are one document and are cut alike, an id that is null counts as the smallest; a deleted line
goes with its line break.  Input columns stay, whatever they are called; those named like a result
column (n_lines, n_removed) are replaced.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import fresh, map_arrow, materialise
from ._text import NEWLINE, SPACE, Words, grams, mix, word_chunks

MIN_LINES = 2
LONG_WORDS = 50
HOT_SHARE = 1e-4
RESULT = ("n_lines", "n_removed")


class Lines:
    """Numbers, hashes and word counts of the lines of a run of documents that aren't blank."""

    def __init__(self, words: Words):
        self.words = words
        inside = ~SPACE[words.data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        at_line = words.start[words.start < len(inside)]
        starts[at_line] |= inside[at_line]
        before = np.concatenate([[0], np.cumsum(starts)])
        self.n_words = before[words.end] - before[words.start]

    def of(self, doc: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lo, hi = self.words.offsets[doc], self.words.offsets[doc + 1]
        full = self.n_words[lo:hi] > 0
        return np.flatnonzero(full), self.words.hash[lo:hi][full], self.n_words[lo:hi][full]


def selected(h: np.ndarray, width: int) -> np.ndarray:
    """Of each window of ``width`` values the place of its smallest, the leftmost of equal ones."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    return np.arange(len(h) - width + 1) + np.lib.stride_tricks.sliding_window_view(h, width).argmin(axis=1)


POSITIONS = "fingerprint long, doc_id long, row long, matches array<struct<first:int,match:long,n:int>>"


def _positions(min_lines: int, long_words: int):
    """Each selected line with the matches around it, one a window that selects it; long lines match alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, rows = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            out = []
            for at, words in word_chunks(batch.column(2), NEWLINE):
                lines = Lines(words)
                for d in range(len(words)):
                    _, h, n_words = lines.of(d)
                    place = selected(h, min_lines)
                    alone = np.flatnonzero(n_words >= long_words)
                    if not len(place) + len(alone):
                        continue
                    # Places never go back from one window to the next, so windows of one place are neighbours.
                    opens = np.flatnonzero(np.diff(place, prepend=-1))
                    first = np.arange(len(place))
                    # How far the match reaches to the left of the fingerprint is part of it.
                    match = mix(grams(h, min_lines) + (place - first).astype(np.uint64))
                    width = np.concatenate([np.diff(opens, append=len(place)), np.ones(len(alone), np.int64)])
                    size = np.full(len(place) + len(alone), min_lines)
                    size[len(place) :] = 1
                    out.append((h[np.concatenate([place[opens], alone])], np.full(len(width), doc_ids[at + d]), np.full(len(width), rows[at + d]), width, np.concatenate([first, alone]), np.concatenate([match, h[alone]]), size))
            if out:
                fingerprint, doc, row, width, first, match, size = (np.concatenate(c) for c in zip(*out))
                matches = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(match.view(np.int64)), pa.array(size.astype(np.int32))], names=["first", "match", "n"])
                matches = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(width)]).astype(np.int32)), matches)
                yield pa.RecordBatch.from_arrays([pa.array(fingerprint.view(np.int64)), pa.array(doc.astype(np.int64)), pa.array(row), matches], names=["fingerprint", "doc_id", "row", "matches"])

    return run


def _later(places: DataFrame, hot_share: float) -> DataFrame:
    """The windows whose match stands at an earlier place too."""
    match, place = ["fingerprint", "match", "n"], F.struct("doc_id", "row", "first")
    most = places.count() * hot_share
    # Fingerprints that stand once end here: each task sends one row for each of its fingerprints.
    again = materialise(places.groupBy("fingerprint").agg(F.count("*").alias("_n")).where("_n > 1"), "lines-repeated")
    # Counts over ``most`` sum to no more than all positions or windows, so both broadcast tables are bounded by the share.
    hot = again.where(F.col("_n") > most).select("fingerprint")
    extended = lambda rows: rows.select("fingerprint", "doc_id", "row", F.inline("matches"))

    def leads(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*match).agg(F.min(place).alias("_lead"), F.count("*").alias("_n")).where("_n > 1")

    # Hot rows leave before the shuffle by fingerprint.
    rare = extended(places.join(F.broadcast(hot), "fingerprint", "left_anti").join(again.where(F.col("_n") <= most), "fingerprint", "left_semi"))
    common = extended(places.join(F.broadcast(hot), "fingerprint", "left_semi"))
    common_leads = leads(common)
    top = F.broadcast(common_leads.where(F.col("_n") > most))
    pairs = [
        rare.join(leads(rare), match),
        common.join(top, match),
        common.join(top, match, "left_anti").join(common_leads.where(F.col("_n") <= most), match),
    ]
    found = [p.where(place > F.col("_lead")).select("doc_id", "row", "first", "n") for p in pairs]
    return found[0].union(found[1]).union(found[2])


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int = LONG_WORDS, hot_share: float = HOT_SHARE) -> DataFrame:
    """``docs`` with later repeats of ``min_lines`` lines, or of a line of ``long_words`` words, cut from ``text``, and n_lines and n_removed."""
    fields = [f for f in docs.schema.fields if f.name not in RESULT]
    doc_id, row, repeats = (fresh(docs.columns, n) for n in ("_doc", "_row", "_repeats"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    # The number of a row tells rows of one id apart.
    keyed = docs.select(*[F.col(f"`{f.name}`") for f in fields], key.alias(doc_id), F.xxhash64("doc_id", "text").alias(row))
    places = materialise(map_arrow(keyed.select(doc_id, row, "text"), _positions(min_lines, long_words), POSITIONS), "lines-positions")
    found = _later(places, hot_share)
    later = found.groupBy(F.col("doc_id").alias(doc_id), F.col("row").alias(row)).agg(F.collect_set(F.struct("first", "n")).alias(repeats))
    return _cut(keyed.join(later, [doc_id, row], "left").select(*[F.col(f"`{f.name}`") for f in fields], F.col(repeats)), fields)


def _cut(joined: DataFrame, fields: list) -> DataFrame:
    names = [f.name for f in fields]
    text_at = names.index("text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_lines int, n_removed int"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeats = batch.column(len(names)).to_pylist()
            texts, n_lines, n_removed = batch.column(text_at).to_pylist(), [], []
            for at, words in word_chunks(batch.column(text_at), NEWLINE):
                lines = Lines(words)
                for d in range(len(words)):
                    numbers, h, _ = lines.of(d)
                    gone = np.zeros(len(h), bool)
                    for r in repeats[at + d] or ():
                        gone[r["first"] : r["first"] + r["n"]] = True
                    n_lines.append(len(h))
                    n_removed.append(int(gone.sum()))
                    if gone.any():
                        texts[at + d] = _without(words, d, numbers[gone])
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int32()), pa.array(n_removed, pa.int32())], names=[*names, *RESULT])

    return map_arrow(joined, cut, schema)


def _without(words: Words, doc: int, numbers: np.ndarray) -> str:
    """The text without some of its lines, each cut with the line breaks after it."""
    base, lo, hi = words.bounds[doc], words.offsets[doc], words.offsets[doc + 1]
    raw = words.data[base : words.bounds[doc + 1]].tobytes()
    starts = np.concatenate([words.start[lo:hi] - base, [len(raw)]])
    out, at = [], 0
    for i in numbers.tolist():
        out.append(raw[at : starts[i]])
        at = starts[i + 1]
    return b"".join([*out, raw[at:]]).decode()
