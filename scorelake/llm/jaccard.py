"""N-gram Jaccard join as a blocked sparse product of the document by n-gram matrix.

The matrix has a row for each different shingle set and a column for each shingle; rows i and j
of its product with its transpose hold the overlap of two documents, and documents link when
``den * overlap >= num * union``.  Overlaps are accumulated over blocks of columns, and after each
block pairs are dropped whose overlap so far, and what their sizes still allow, is below the one
that a link needs.

* The first block holds each row's rarest columns: as a link needs an overlap of at least
  num/den of a row's size n, two linked rows share one of their n - ceil(n*num/den) + 1 first
  columns in any common order.  Common columns come last in it.  The block's product is a join on
  the column and a sum per pair.  Of the row whose block ends first in the order, columns that
  weren't met can't be in the other row at all, which with the sum bounds the whole overlap.
* The whole rows of the pairs that are left are multiplied in further blocks, ranges of the
  columns' hashes, with the bound checked after each.

Rows with equal sets are one row from the start, so exact copies never meet.  Within a column a
large group of near copies isn't multiplied out: each document is first compared with the column's
leading document, linked ones merge to components, and then only pairs across components are
compared (one side always outside the column's largest component).  A column in which unlinked
documents are many is split: two linked rows share at least k of their n - ceil(n*num/den) + k
first columns, so such a column stands together with a second one (a third, a fourth) in its place.
No link between different components is lost, so components are exact up to collisions of 64-bit
shingle hashes.

Empty and null texts have empty sets and link with nothing: each row is its own component.
Repeated rows, and rows of one id with different texts, are rows like others: the component of a
row is the smallest id among all rows it reaches, null if none of them has one.  Texts are used
whole, however long.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._heavy import FOLD_AT, heavy_values
from ._spark import drop_scratch, map_arrow, materialise
from ._text import SPACE, mix, shingle_set, word_chunks
from .components import connected_components

SHINGLE = 5
NUM, DEN = 80, 100
COMMON_SHARE = 0.002
BLOCK_ENTRIES = 500_000
COLUMN_PAIRS = 4_000_000
DEPTH = 4
HASH_BLOCKS = 4


def _need(n, num: int, den: int):
    """Least overlap of a set of size ``n`` with anything it links to."""
    return -(-n * num // den)


def common_shingles(docs: DataFrame, shingle: int, share: float = COMMON_SHARE, fold_at: int = FOLD_AT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that stand in at least ``share`` of all documents, and their places by rarity.

    The list only orders columns: a shingle that it misses costs time, not a link.
    """
    values, n = heavy_values(docs, SPACE, True, lambda words, d: shingle_set(words.hash[words.offsets[d] : words.offsets[d + 1]], shingle), share, fold_at)
    place = np.empty(len(values), np.int64)
    place[np.lexsort((values, n))] = np.arange(len(values))
    return values, place


def _node(columns: np.ndarray) -> int:
    """A 64-bit identity of a set: the sum over its hashed columns."""
    return int(mix(columns).sum(dtype=np.uint64).view(np.int64))


def signatures(docs: DataFrame, shingle: int, num: int, den: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, digest of the text, node (what identifies the set), n, the first columns in order, and where the first block ends.

    ``prefix`` holds the first block and DEPTH - 1 columns after it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, place = shared.value
        for batch in batches:
            sizes, nodes, prefixes, ends = [], [], [], []
            for _, words in word_chunks(batch.column(1), SPACE, lower=True):
                for d in range(len(words)):
                    s = shingle_set(words.hash[words.offsets[d] : words.offsets[d + 1]], shingle)
                    n = len(s)
                    sizes.append(n)
                    nodes.append(_node(s))
                    p, ranks = n - _need(n, num, den) + 1 if n else 0, np.zeros(0, np.int64)
                    if n and len(values):
                        at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                        is_common = values[at] == s
                        ranks = np.sort(place[at[is_common]])
                        tail = s[is_common][np.argsort(place[at[is_common]])]
                        s = np.concatenate([s[~is_common], tail])
                    prefixes.append(s[: p + DEPTH - 1 if n else 0].view(np.int64))
                    # Where the block ends in the common order: by hash, and common columns by rank at its top.
                    if p <= n - len(ranks):
                        ends.append(int((s[p - 1] ^ np.uint64(1 << 63)).view(np.int64)) if n else 0)
                    else:
                        ends.append((1 << 63) - len(values) + int(ranks[p - 1 - n + len(ranks)]))
            lengths = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)), pa.array(ends, pa.int64())],
                names=["doc_id", "digest", "node", "n", "prefix", "end"],
            )

    return map_arrow(docs.select("doc_id", "text", "digest"), run, "doc_id long, digest long, node long, n int, prefix array<long>, end long")


MOST_FILTER_BITS = 1 << 27


def _filter_bits(wanted: DataFrame) -> np.ndarray:
    """A bitmap over the digests of ``wanted``, 64 bits each and 16 MB at most: no false negatives."""
    size = min(MOST_FILTER_BITS, max(1 << 16, 1 << (64 * wanted.count()).bit_length()))
    slots = wanted.select(F.expr(f"cast(pmod(digest, {size}) as int)").alias("slot"))
    words = slots.groupBy(F.expr("slot div 64").cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits"))
    found = words.toPandas()  # at most MOST_FILTER_BITS / 64 rows, through Arrow
    bits = np.zeros(size // 64, np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits


def _asked(bits: np.ndarray, digests: np.ndarray) -> pa.Array:
    slot = digests % (64 * len(bits))
    return pa.array((bits[slot // 64] >> (slot % 64)) & 1 == 1)


def _only(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose ``column`` is wanted (there ``digest``), and a few others, without moving the rest."""
    shared = rows.sparkSession.sparkContext.broadcast(_filter_bits(wanted))
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            yield batch.filter(_asked(bits, batch.column(at).to_numpy()))

    return map_arrow(rows, run, rows.schema)


def shingle_sets(rows: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, columns) of every text of ``rows`` (text, digest) whose digest is wanted, and of a few others.

    Texts stay where they are: a bitmap of the wanted digests goes to them, so that only sets are
    shuffled.  Where it fills up, more sets that nobody asks for get through; none is lost.
    """
    shared = rows.sparkSession.sparkContext.broadcast(_filter_bits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            batch = batch.filter(_asked(bits, batch.column(1).to_numpy()))
            for _, words in word_chunks(batch.column(0), SPACE, lower=True):
                sets = [shingle_set(words.hash[words.offsets[d] : words.offsets[d + 1]], shingle) for d in range(len(words))]
                lengths = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                columns = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), columns], names=["node", "columns"])

    return map_arrow(rows.select("text", "digest"), run, "node long, columns array<long>")


def _multiply(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that link: overlap counts of two sparse rows, each pair once."""
    left = sets.select(F.col("node").alias("a"), F.col("columns").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("columns").alias("_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "_a", "_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pa.compute.add(pa.compute.list_value_length(batch.column(2)), pa.compute.list_value_length(batch.column(3))).to_numpy())
            row = 0
            while row < batch.num_rows:  # a block of rows with a bounded number of entries, or one row
                end = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + BLOCK_ENTRIES, "right")))
                yield product(batch.slice(row, end - row))
                row = end

    def product(block: pa.RecordBatch) -> pa.RecordBatch:
        one, two = block.column(2), block.column(3)
        columns = np.concatenate([one.flatten().to_numpy(), two.flatten().to_numpy()]).view(np.uint64)
        nx, ny = np.diff(one.offsets.to_numpy()), np.diff(two.offsets.to_numpy())
        row = np.concatenate([np.repeat(np.arange(len(nx)), nx), np.repeat(np.arange(len(ny)), ny)])
        of_x = np.arange(len(row)) < nx.sum()
        part = (columns >> np.uint64(32)) % np.uint64(HASH_BLOCKS)
        needed = -(-num * (nx + ny) // (num + den))
        overlap, left_x, left_y, alive = np.zeros(len(nx), np.int64), nx.copy(), ny.copy(), np.ones(len(nx), bool)
        for i in range(HASH_BLOCKS):
            own = (part == i) & alive[row]
            left_x -= np.bincount(row[own & of_x], minlength=len(nx))
            left_y -= np.bincount(row[own & ~of_x], minlength=len(nx))
            # Entries of both rows side by side: a column met twice in one pair is an overlap.
            order = np.argsort(key := mix(columns[own] + mix(row[own].astype(np.uint64))), kind="stable")
            key = key[order]
            overlap += np.bincount(row[own][order][1:][key[1:] == key[:-1]], minlength=len(nx))
            alive &= overlap + np.minimum(left_x, left_y) >= needed
        keep = pa.array(alive)
        return pa.RecordBatch.from_arrays([block.column(0).filter(keep), block.column(1).filter(keep)], names=["a", "b"])

    return map_arrow(both, run, "a long, b long")


def _needed(x: str, y: str, num: int, den: int) -> str:
    return f"cast(ceil({num} * ({x}.n + {y}.n) / {num + den}) as int)"


def _alike(x: str, y: str, num: int, den: int) -> str:
    """Condition: the sizes allow a link."""
    return f"{den} * least({x}.n, {y}.n) >= {num} * greatest({x}.n, {y}.n)"


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN, common_share: float = COMMON_SHARE, column_pairs: int = COLUMN_PAIRS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    A column with more than ``column_pairs`` pairs across components is split by further columns.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    signed = materialise(signatures(rows, shingle, num, den, common_shingles(rows, shingle, common_share)), "jaccard-signatures")
    # One row per set; the text of its smallest document stands for it.
    full = signed.where("n > 0")
    lead = F.min(F.struct("doc_id", "digest"))
    classes = full.groupBy("node", "n").agg(F.min("doc_id").alias("least_id"), lead.alias("lead"), F.first("prefix").alias("prefix"), F.first("end").alias("end"))
    classes = materialise(classes, "jaccard-classes")
    leads = classes.select("node", _row_key("lead.doc_id", "lead.digest").alias("digest"))
    firsts = classes.select("node", "n", "prefix", "end", F.expr(f"cast(n - ceil(n * {num} / {den}) + 1 as int)").alias("p"))

    # The first column block: column, set, size, place in the order.
    entries = firsts.select("node", "n", F.posexplode(F.slice("prefix", F.lit(1), F.col("p"))).alias("at", "column"))
    by_column = Window.partitionBy("column")
    # The leading set of a column is that with the fewest rarer columns.
    met = entries.repartition("column").withColumns({"_rows": F.count("*").over(by_column), "lead": F.min(F.struct("at", "n", "node")).over(by_column)}).where("_rows > 1").drop("_rows")
    block = materialise(met, "jaccard-block")

    stars = (
        block.alias("x").selectExpr("x.node", "x.n", "x.at", "x.lead as y").where("node <> y.node")
        .where(f"least(n - at, y.n - y.at) >= cast(ceil({num} * (n + y.n) / {num + den}) as int) and {den} * least(n, y.n) >= {num} * greatest(n, y.n)")
        .select(F.least("node", "y.node").alias("a"), F.greatest("node", "y.node").alias("b")).distinct()
    )
    stars = materialise(_bounded(stars, firsts, num, den), "jaccard-stars")
    sets = _sets_of(stars, rows, leads, shingle)
    linked = materialise(_multiply(stars, sets, num, den), "jaccard-links")
    drop_scratch(spark, sets)
    parts = connected_components(linked).withColumnRenamed("component", "part")

    rest = materialise(_across(block, parts, firsts, num, den, column_pairs).join(stars, ["a", "b"], "left_anti"), "jaccard-rest")
    for used in (block, stars, linked):
        drop_scratch(spark, used)
    # The first components are stars already; only new links are added to them.
    sets = _sets_of(rest, rows, leads, shingle)
    links = materialise(parts.select(F.col("node").alias("a"), F.col("part").alias("b")).unionByName(_multiply(rest, sets, num, den)), "jaccard-links")
    drop_scratch(spark, sets)
    drop_scratch(spark, rest)
    merged = connected_components(links)
    drop_scratch(spark, links)

    # Components are named by their smallest document.
    named = classes.select("node", "n", "least_id").join(merged, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_node = named.join(names, "component").select("node", "n", "component_id")
    empty = signed.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "node", "n").join(of_node, ["node", "n"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").unionByName(empty)


def _row_key(doc_id: str, digest: str):
    return F.xxhash64(F.coalesce(doc_id, F.lit(0).cast("long")), digest)


def _across(block: DataFrame, parts: DataFrame, firsts: DataFrame, num: int, den: int, column_pairs: int) -> DataFrame:
    """Pairs (a, b) of one column in different components that the first block leaves possible."""
    spark = block.sparkSession
    nodes = firsts.select("node", "p", "end").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    placed = block.drop("lead").join(nodes, "node")
    found = None
    for depth in range(DEPTH):
        # Of each column its largest component, and how many pairs have a side outside of it.
        by_column, by_part = Window.partitionBy("column"), Window.partitionBy("column", "part")
        sized = placed.repartition("column").withColumn("_n", F.count("*").over(by_part))
        sized = sized.withColumns({"main": F.max(F.struct("_n", "part")).over(by_column), "rows": F.count("*").over(by_column)}).where("main._n < rows")
        wide = F.expr(f"(rows - main._n) * rows > {column_pairs}") if depth < DEPTH - 1 else F.lit(False)
        mixed = materialise(sized.withColumns({"wide": wide, "inner": F.col("part") == F.col("main.part")}).drop("_n", "rows", "main"), "jaccard-mixed")
        wide = mixed.where("wide").select("column", "node", "n", "p", "at", "part")
        split = depth < DEPTH - 1 and not wide.isEmpty()
        narrow = mixed.where("not wide")
        if depth == 0:
            # A row's columns that are split aren't counted here: they may all be met.
            open_columns = wide.groupBy("node").agg(F.count("*").cast("int").alias("open")) if split else None
            narrow = narrow.join(open_columns, "node", "left").withColumn("open", F.coalesce("open", F.lit(0))) if split else narrow.withColumn("open", F.lit(0))
            narrow = narrow.withColumn("missing", F.col("n") - F.col("p") + F.col("open")).drop("p", "open")
        narrow = narrow.drop("wide")
        x, y = narrow.where("not inner").drop("inner").alias("x"), narrow.alias("y")
        apart = f"x.column = y.column and x.part <> y.part and (y.inner or x.node < y.node) and {_alike('x', 'y', num, den)}"
        pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
        if depth == 0:
            # What was met before this column and what can be met from here on.
            apart += f" and least(x.at, y.at) + least(x.n - x.at, y.n - y.at) >= {_needed('x', 'y', num, den)}"
            least = F.expr(f"{_needed('x', 'y', num, den)} - if(x.end <= y.end, x.missing, y.missing)")
            product = x.join(y, F.expr(apart)).select(*pair, least.alias("_least"))
            pairs = product.groupBy("a", "b").agg(F.count("*").alias("_met"), F.max("_least").alias("_least")).where("_met >= _least").select("a", "b")
        else:
            pairs = _bounded(x.join(y, F.expr(apart)).select(*pair).distinct(), firsts, num, den)
        pairs = materialise(pairs, "jaccard-pairs")
        found = pairs if found is None else found.unionByName(pairs)
        if not split:
            break
        # The column together with each one after it, up to one more place than before.
        deeper = wide.join(firsts.select("node", "prefix"), "node")
        placed = materialise(
            deeper.select("node", "n", "p", "part", F.posexplode("prefix").alias("_at", "_next"), "column", "at").where(f"_at > at and _at < p + {depth + 1}")
            .select(F.xxhash64("column", "_next").alias("column"), "node", "n", "p", F.col("_at").alias("at"), "part"),
            "jaccard-split",
        )
        drop_scratch(spark, mixed)
    return found.distinct() if depth else found


def _bounded(pairs: DataFrame, firsts: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose overlap inside the first block still allows the one that their sizes ask for."""
    pairs = materialise(pairs, "jaccard-pairs")
    firsts = _only(firsts, "node", pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))))
    side = lambda x: firsts.select(F.col("node").alias(x), F.struct("n", "p", F.slice("prefix", F.lit(1), F.col("p")).alias("prefix"), "end").alias(f"_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("_met", F.expr("size(array_intersect(_a.prefix, _b.prefix))"))
    missed = "case when _a.end <= _b.end then _a.n - _a.p + _met else _b.n - _b.p + _met end"
    return both.where(f"{missed} >= {_needed('_a', '_b', num, den)}").select("a", "b")


def _sets_of(pairs: DataFrame, rows: DataFrame, leads: DataFrame, shingle: int) -> DataFrame:
    """The sets that ``pairs`` name, from the text of one document each."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = materialise(nodes.join(leads, "node").select("digest"), "jaccard-wanted")
    keyed = rows.select("text", _row_key("doc_id", "digest").alias("digest"))
    sets = materialise(shingle_sets(keyed, wanted, shingle), "jaccard-sets")
    drop_scratch(pairs.sparkSession, wanted)
    return sets
