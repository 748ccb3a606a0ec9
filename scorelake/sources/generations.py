"""Keyed tables whose writes replace only what their keys fall into.

Rows are dealt to a fixed number of buckets by a hash of their key.  A write reads the buckets that
its rows touch, and writes these whole as the next generation; files of other buckets stay as they
are.  A table is each bucket's latest generation that was written to its end, so a run that dies
leaves the table as it was, and a run that is repeated under its number gives the same files.  Rows
are replaced or added, never removed; null keys are keys like others.  One writer at a time.

    <path>/buckets=<number>/generation=<n>/_bucket=<b>/part-...

Choose the number of buckets so that a bucket has some hundred MB; it can't change later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_keyed

BUCKETS = 64


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers n of the folders ``<name>=n`` under ``path``."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where) if s.isDirectory()]
    return sorted(int(n.removeprefix(f"{name}=")) for n in names if n.startswith(f"{name}="))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _root(spark: SparkSession, path: str, buckets: int | None = None) -> str | None:
    known = _folders(spark, path, "buckets")
    if known and buckets and known != [buckets]:
        raise ValueError(f"{path} has {known[0]} buckets, not {buckets}")
    number = known[0] if known else buckets
    return f"{path.rstrip('/')}/buckets={number}" if number else None


def latest(spark: SparkSession, path: str, before: int | None = None) -> dict[int, int]:
    """Each bucket's latest whole generation, of those before ``before``."""
    root = _root(spark, path)
    found: dict[int, int] = {}
    for n in _folders(spark, root, "generation") if root else []:
        folder = f"{root}/generation={n}"
        if (before is None or n < before) and _exists(spark, f"{folder}/_SUCCESS"):
            found |= dict.fromkeys(_folders(spark, folder, "_bucket"), n)
    return found


def read(spark: SparkSession, path: str, before: int | None = None, only: set[int] | None = None) -> DataFrame | None:
    """The table, or the buckets ``only`` of it; None if there is nothing."""
    root = _root(spark, path)
    paths = [f"{root}/generation={n}/_bucket={b}" for b, n in sorted(latest(spark, path, before).items()) if only is None or b in only]
    # Generations can differ by added columns.
    return spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None


def merge(
    spark: SparkSession, path: str, changes: DataFrame, keys: list[str], combine: Callable[[DataFrame | None, DataFrame], DataFrame], generation: int | None = None, buckets: int = BUCKETS
) -> set[int]:
    """Write ``combine(rows of the touched buckets or None, changes)`` as a generation; the touched buckets.

    ``combine`` must keep every row of a key that isn't in ``changes``.  A generation that was written
    under this number before is written again from the ones before it; without a number it is the next.
    """
    root = _root(spark, path, buckets)
    known = _folders(spark, root, "generation")
    number = generation if generation is not None else (known[-1] + 1 if known else 0)
    # The changes are read twice and must be the same rows both times, also from a live source.
    pending = f"{root}/pending={number}"
    changes.write.mode("overwrite").parquet(pending)
    changes = spark.read.schema(changes.schema).parquet(pending)
    touched = {r[0] for r in changes.select(bucket(keys, buckets)).distinct().collect()}  # at most the number of buckets
    if touched:
        combined = combine(read(spark, path, number, touched), changes).withColumn("_bucket", bucket(keys, buckets))
        # Adaptive execution makes few files of small buckets and several of large ones.
        combined.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{root}/generation={number}")
    _delete(spark, pending)
    return touched


def replace_keys(old: DataFrame | None, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A ``combine``: changes replace rows of the same key."""
    if old is None:
        return changes
    return join_keyed(old, changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes, allowMissingColumns=True)


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete bucket folders that a later generation replaces, once nothing reads them; their number."""
    root, kept, gone = _root(spark, path), latest(spark, path), 0
    for n in _folders(spark, root, "generation") if root else []:
        folder = f"{root}/generation={n}"
        if not _exists(spark, f"{folder}/_SUCCESS"):
            continue
        for b in _folders(spark, folder, "_bucket"):
            if kept[b] != n:
                _delete(spark, f"{folder}/_bucket={b}")
                gone += 1
    return gone
