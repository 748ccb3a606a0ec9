"""Near duplicates among embeddings: sign hashes of random hyperplanes in several tables, exact cosines, connected components.

Vectors meet only if their labels are equal and not null, and their dimensions are equal.  Each of
``tables`` hash tables files a vector under the signs of its products with some random hyperplanes.
The vectors of a bucket are multiplied with each other, and a pair with a cosine of at least
``least`` is a link.  A pair that meets in several tables is counted in the first of them: the rows of
a bucket carry their signs in the earlier tables, so no pair ever leaves the task that found it.
What leaves are numbers of links and, from each part of a bucket, one edge a vector at most.

Hyperplanes a table grow with the logarithm of the largest label's vectors, so random buckets keep
their size; tables follow from them, so that a pair at the threshold is missed by all tables with a
probability of ``miss``.  Pairs more alike than that are missed less often.

Large groups of near copies, which no hash can split, become *cores* first: vectors within less than
half the threshold's angle of a common centre are all linked with each other by the triangle
inequality of angles.  A core counts its links by its size, is one node for the components, and the
parts of a bucket that belong to one core aren't multiplied.  Centres come from buckets that hold
more than ``CORE_SHARE`` of all vectors (hence at most 1 / CORE_SHARE buckets) and CORE_LEAST
vectors, by a sample of some SAMPLE vectors each.  The sample decides only how fast a group is done:
every vector is compared with the centres of its label, and what is in no core goes the other way.
Buckets of more than PART vectors are dealt in parts, and each pair of parts is a task's group.

Vectors are shuffled once a table, TABLES_A_ROUND tables at a time, whose numbers are written before
the next round starts.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components, and one
without a label, links with nothing.  Every row is a vector: rows of one id, or of none, count each
other.  component_id is the smallest id of the component (null only if none has an id); ``kept`` holds
where the row's id is that.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import drop_scratch, map_arrow, materialise
from .components import connected_components

COSINE = 0.93
MISS = 0.02
#: Random vectors that a bucket may hold; below, hyperplanes aren't more than LEAST_BITS.
BUCKET, LEAST_BITS, MOST_BITS = 1024, 8, 30
PART = 1024
TABLES_A_ROUND = 3
CORE_SHARE, CORE_LEAST, SAMPLE, CENTRES = 0.001, 256, 32, 8
#: Radians by which a core stays inside half the threshold's angle, far above rounding.
MARGIN = 1e-6

SIGNED = "node long, vec_id long, label string, dim int, vector binary, signs array<int>"


@lru_cache(maxsize=8)
def hyperplanes(dim: int, number: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, number))


def table_sizes(largest: int, least: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(hyperplanes a table, tables) for ``largest`` vectors that may meet."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, largest / BUCKET)))))
    together = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - together))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _doubles(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), f"f{len(raw[0]) // dim}").reshape(-1, dim).astype(np.float64)


def signed_vectors(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """One row a vector: a number of its own, id, label, dimension, components, and its signs in each table; null signs for what links with nothing.

    Components stay single floats if they come as such.  Doubles are scaled by a power of two, which
    changes no cosine, so that squares neither overflow nor vanish.
    """
    powers = 1 << np.arange(bits)
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            dims = pd.Series(column.value_lengths().to_numpy(zero_copy_only=False)).fillna(0).to_numpy(np.int64)
            raw, signs = np.full(len(dims), None, object), np.full(len(dims), None, object)
            labelled = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims[labelled & (dims > 0)]):
                rows = np.flatnonzero(labelled & (dims == dim))
                x = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # nulls become nan
                most = np.abs(x).max(1)
                good = np.isfinite(most) & (most > 0)
                rows, x = rows[good], x[good] if kind == "float" else np.ldexp(x[good], -np.frexp(most[good])[1][:, None])
                bit = (x @ hyperplanes(int(dim), bits * tables) >= 0).reshape(len(x), tables, bits)
                for r, v, s in zip(rows, x.astype(np.float32 if kind == "float" else np.float64), (bit * powers).sum(2).astype(np.int32)):
                    raw[r], signs[r] = v.tobytes(), s
            arrays = [batch.column(0), batch.column(1), batch.column(2), pa.array(dims.astype(np.int32)), pa.array(raw, pa.binary()), pa.array(signs, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SIGNED.split(", ")])

    rows = vectors.select(F.monotonically_increasing_id().alias("node"), F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast(f"array<{kind}>"))
    return map_arrow(rows, run, SIGNED)


def find_centres(signed: DataFrame, total: int, least: float) -> list[tuple[str, int, bytes]]:
    """(label, dimension, centre) of groups in the first table's crowded buckets; a bounded list."""
    key = ["label", "dim", "sign"]
    rows = signed.where("signs is not null").withColumn("sign", F.col("signs")[0])
    crowded = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > max(CORE_LEAST, CORE_SHARE * total))
    # Fewer than 1 / CORE_SHARE buckets, whatever the input.
    sampled = rows.join(F.broadcast(crowded), key).where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < (1 << 30) * SAMPLE / F.col("n")).select(*key, "vector")
    half = math.acos(least) / 2 - MARGIN

    def centres(frame: pd.DataFrame) -> pd.DataFrame:
        x, found = _unit(_doubles([*frame["vector"]], frame["dim"].iloc[0])), []
        while len(x) > 1 and len(found) < CENTRES:
            near = x @ x.T >= math.cos(half)
            group = near[near.sum(1).argmax()]
            if group.sum() < 2:
                break
            centre = x[group].sum(0)
            found.append(centre.tobytes())
            x = x[~group & (x @ (centre / np.linalg.norm(centre)) < math.cos(half))]
        return pd.DataFrame({"label": frame["label"].iloc[0], "dim": frame["dim"].iloc[0], "centre": found})

    return [(r["label"], r["dim"], bytes(r["centre"])) for r in sampled.groupBy(*key).applyInPandas(centres, "label string, dim int, centre binary").orderBy("label", "dim", "centre").collect()]


def with_cores(signed: DataFrame, centres: list[tuple[str, int, bytes]], least: float) -> DataFrame:
    """Rows with ``core``, the number of the nearest centre within half the threshold's angle; else null."""
    by_kind: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    for kind in {(label, dim) for label, dim, _ in centres}:
        own = [i for i, c in enumerate(centres) if c[:2] == kind]
        by_kind[kind] = np.array(own), _unit(np.stack([np.frombuffer(centres[i][2]) for i in own]))
    half = math.acos(least) / 2 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = np.full(batch.num_rows, -1)
            labels, dims, raw = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
            known = raw.is_valid().to_numpy(zero_copy_only=False)
            kinds = pd.Series([*zip(labels, dims)], dtype=object)
            for kind, (numbers, middles) in by_kind.items():
                rows = np.flatnonzero(known & (kinds == kind).to_numpy())
                if len(rows):
                    near = _unit(_doubles(raw.take(pa.array(rows)).to_pylist(), kind[1])) @ middles.T
                    best = near.argmax(1)
                    inside = near[np.arange(len(rows)), best] >= math.cos(half)
                    core[rows[inside]] = numbers[best[inside]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(core, pa.int32(), mask=core < 0)], names=[*batch.schema.names, "core"])

    return map_arrow(signed, run, f"{SIGNED}, core int") if centres else signed.withColumn("core", F.lit(None).cast("int"))


def _local_roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each place reaches by the links (a, b)."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def part_links(group: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, numbers of links first met here, root places) of a part of a bucket, or of two different parts (``side`` 0 and 1)."""
    nodes, core, side = (group[c].to_numpy() for c in ("node", "in_core", "side"))
    x = _doubles(group["vector"].to_pylist(), group["dim"][0].as_py())
    norms = np.linalg.norm(x, axis=1)
    signs = np.stack(group["signs"].to_numpy())  # of this table and the earlier ones
    here = signs.shape[1] - 1
    one = group["low"][0].as_py() == group["high"][0].as_py()  # else rows of a single part meet nothing here
    left, right = (np.arange(len(nodes)),) * 2 if one else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    firsts, seconds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        cosine = (x[rows] @ x[right].T) / (norms[rows][:, None] * norms[right][None, :])
        i, j = np.nonzero(cosine >= least)
        i, j = rows[i], right[j]
        new = (i < j if one else i != j) & ((core[i] < 0) | (core[i] != core[j]))
        i, j = i[new], j[new]
        new = ~(signs[i, :here] == signs[j, :here]).any(1)
        firsts.append(i[new])
        seconds.append(j[new])
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    number = np.bincount(np.concatenate([a, b]), minlength=len(nodes))
    places = np.flatnonzero(number)
    return places, number[places], _local_roots(len(nodes), a, b)[places]


def near_cores(rows: DataFrame, centres: list[tuple[str, int, bytes]], least: float) -> DataFrame:
    """(in_core, other_core), both ways: cores whose members can be linked with each other by the angle of their centres."""
    most = math.cos(min(math.pi, 2 * math.acos(least) + 2 * MARGIN))  # a core reaches less than half the threshold's angle each way
    pairs = []
    for kind in {c[:2] for c in centres}:
        own = np.array([i for i, c in enumerate(centres) if c[:2] == kind])
        middles = _unit(np.stack([np.frombuffer(centres[i][2]) for i in own]))
        for at, i in enumerate(own):
            pairs += [(int(i), int(j)) for j in own[middles @ middles[at] >= most] if i != j]
    return rows.sparkSession.createDataFrame(pairs, "in_core int, other_core int")


def bucket_links(rows: DataFrame, near: DataFrame, tables: list[int], least: float) -> DataFrame:
    """(node, core, n, root): links of a vector first met in these tables, from each part of a bucket, and the node or core that it reaches by them.

    What the vectors of a round are joined with is written first, so Spark broadcasts it only if its files are small.
    """
    spark, key = rows.sparkSession, ["label", "dim", "table", "sign"]
    entries = rows.where("signs is not null").select(
        "node", "label", "dim", F.coalesce("core", F.lit(-1)).alias("in_core"), "vector", "signs", F.explode(F.array(*map(F.lit, tables))).alias("table")
    ).withColumn("sign", F.expr("signs[table]"))
    sizes = entries.groupBy(*key, "in_core").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy(*key).agg(F.sum("n").alias("total"), F.collect_list(F.struct("in_core", "n")).alias("groups"))  # at most a bucket's cores and the rest
    large = sizes.where(F.col("total") > PART).select(*key, F.inline("groups")).select(*key, "in_core", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    large = materialise(large, "neardup-large")
    # In large buckets a row goes to the pairs of its own part with every part of its bucket, but for those of its own core and of cores too far away.
    own = large.select(*key, "in_core", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    other = own.select(*key, F.col("in_core").alias("other_core"), F.col("part").alias("other_part"))
    meets = own.join(other, key).join(near.withColumn("near", F.lit(True)), ["in_core", "other_core"], "left").where("in_core = -1 or other_core = -1 or near")
    mine, theirs = F.struct("in_core", "part"), F.struct(F.col("other_core").alias("in_core"), F.col("other_part").alias("part"))
    meets = meets.select(*key, "in_core", "part", F.least(mine, theirs).alias("low"), F.greatest(mine, theirs).alias("high"), (mine > theirs).cast("int").alias("side"))
    meets = materialise(meets, "neardup-meets")
    dealt = entries.join(large, [*key, "in_core"], "left").withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    dealt = dealt.join(meets, [*key, "in_core", "part"], "left")
    # A part whose bucket has nothing else than its own core and far ones meets nothing.
    tiles = dealt.where("parts is null or low is not null").select(*key, "node", "in_core", "vector", F.expr("slice(signs, 1, table + 1)").alias("signs"), "low", "high", F.coalesce("side", F.lit(0)).alias("side"))

    def run(group: pa.Table) -> pa.Table:
        nodes, core = group["node"].to_numpy(), group["in_core"].to_numpy()
        places = n = root = np.zeros(0, np.int64)
        if len(nodes) > 1:
            places, n, root = part_links(group, least)
            root = np.where(core[root] < 0, nodes[root], -1 - core[root].astype(np.int64))
        return pa.table({"node": nodes[places], "core": core[places], "n": n, "root": root})

    found = tiles.groupBy(*key, "low", "high").applyInArrow(run, "node long, core int, n long, root long")
    found = materialise(found.groupBy("node", "core", "root").agg(F.sum("n").alias("n")), "neardup-links")
    for table in (large, meets):
        drop_scratch(spark, table)
    return found


def near_duplicates(vectors: DataFrame, least: float = COSINE, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    per_label = vectors.where("label is not null").groupBy("label", F.size("embedding")).agg(F.count("*").alias("n"))
    largest, total = per_label.agg(F.max("n"), F.sum("n")).first()
    bits, tables = table_sizes(largest or 0, least, miss)
    signed = materialise(signed_vectors(vectors, bits, tables), "neardup-signed")
    centres = find_centres(signed, total or 0, least)
    rows = signed
    if centres:
        rows = materialise(with_cores(signed, centres, least), "neardup-cores")
        drop_scratch(spark, signed)
    else:
        rows = with_cores(signed, [], least)
    near, rounds = near_cores(rows, centres, least), []
    for at in range(0, tables, TABLES_A_ROUND):
        rounds.append(bucket_links(rows, near, list(range(at, min(tables, at + TABLES_A_ROUND))), least))
    links = rounds[0]
    for r in rounds[1:]:
        links = links.unionByName(r)
    # A core is one node (-1 - its number) of the components.
    edges = links.select(F.when(F.col("core") < 0, F.col("node")).otherwise(-1 - F.col("core")).alias("a"), F.col("root").alias("b")).where("a <> b").distinct()
    joined = connected_components(edges)
    own = rows.select("node", "vec_id", F.when(F.col("core").isNull(), F.col("node")).otherwise(-1 - F.col("core")).alias("member"), F.col("core").isNotNull().alias("cored"))
    # Smallest ids: of each node, then of each component.
    of_node = own.groupBy("member").agg(F.min("vec_id").alias("first"), F.count("*").alias("size"))
    placed = of_node.join(joined, of_node["member"] == joined["node"], "left").select("member", "first", "size", F.coalesce("component", "member").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    placed = placed.join(smallest, "component").select("member", "size", "component_id")
    counted = links.groupBy("node").agg(F.sum("n").alias("n"))
    single = own.where("not cored").join(placed, "member").select("node", "vec_id", F.lit(0).cast("long").alias("inside"), "component_id")
    # Cores are fewer than CENTRES / CORE_SHARE, so their side is small for any input.
    cored = own.where("cored").join(F.broadcast(placed.where("member < 0")), "member").select("node", "vec_id", (F.col("size") - 1).alias("inside"), "component_id")
    both = single.unionByName(cored).join(counted, "node", "left")
    return both.select("vec_id", (F.col("inside") + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
