"""Connected components of an edge table by min-label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import drop_scratch, materialise


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges``.

    Alternates large-star and small-star steps, in which every node points its larger (smaller)
    neighbours to its smallest one, until nothing changes: a number of rounds that grows with the
    logarithm of the edges.  Every round is written to the shared folder, so plans stay short and
    a lost executor costs one round.  A node with many neighbours sends rows, never a list.  Edges
    with a null end and loops are ignored.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = materialise(pairs, "components")
    before = _digest(pairs)
    while True:
        new = _small_star(_large_star(pairs))
        new = materialise(new, "components")
        after = _digest(new)
        drop_scratch(edges.sparkSession, pairs)
        pairs = new
        if after == before:
            break
        before = after
    # A fixpoint is a set of stars: each node points to the smallest of its component.
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _digest(pairs: DataFrame):
    """A number that two edge tables share only if they are equal."""
    return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """``pairs`` have u > v; the smaller neighbours of u, and u itself, point to the smallest."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
