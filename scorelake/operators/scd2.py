"""Slowly changing dimensions, type 2: hashes, versions, apply, rebuild and point-in-time reads.

Intervals are half-open: a version holds from ``_effective_from`` up to, but without,
``_effective_to``.  With ``close_at="business"`` a closed version ends where its successor begins;
``"processing"`` ends it at the run's time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import written
from .joins import join_keyed

#: Rows of a key that one window may order, and bytes of a table in which none is counted.
HOT_ROWS, SMALL_BYTES = 5_000_000, 1 << 30
VERSION = ["_row_hash", "_is_current", "_effective_from", "_effective_to"]
SEPARATOR, MISSING = "\x1f", "\x00"


def text_form(name: str, kind: T.DataType) -> Column:
    """One text for one value: floating point through a fixed scale, binary as hex, null as a sign no text holds."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        column = column.cast("decimal(28,4)")
    elif isinstance(kind, T.BinaryType):
        column = F.hex(column)
    return F.coalesce(column.cast("string"), F.lit(MISSING))


def row_hash(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """MD5 over all columns but the excluded and version ones (exact names), in name order."""
    fields = sorted((f for f in df.schema.fields if f.name not in exclude and f.name not in VERSION), key=lambda f: f.name)
    return F.md5(F.concat_ws(SEPARATOR, *[text_form(f.name, f.dataType) for f in fields]))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in ``order``, which should be total."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def dedup_batch(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Latest version a key; without keys, distinct rows by hash."""
    return latest_per_key(df, keys, order) if keys else df.dropDuplicates(["_row_hash"])


def stamp(df: DataFrame, start: Column) -> DataFrame:
    """Make every row a current version that starts at ``start``."""
    return df.withColumns({"_is_current": F.lit(True), "_effective_from": start, "_effective_to": F.lit(None).cast("timestamp_ntz")})


def versioned(df: DataFrame, keys: list[str], from_col: str, order: list[Column], now: Column) -> DataFrame:
    """A batch, ready to apply: hashed, one row a key, stamped; a null start becomes the run's time."""
    hashed = df.withColumn("_row_hash", row_hash(df, (from_col,)))
    return stamp(dedup_batch(hashed, keys, order), F.coalesce(from_col, now))


def backfill_versions(df: DataFrame, start: Column, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Give an unversioned table its version columns and hashes."""
    return stamp(df.withColumn("_row_hash", row_hash(df, exclude)), start)


def judge(current: DataFrame, batch: DataFrame, keys: list[str], delete_when: Column | None = None) -> DataFrame:
    """A versioned batch with ``_change``: NEW, CHANGED, UNCHANGED, LATE, DELETED or NONE (a delete of nothing)."""
    deleted = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    batch = batch.withColumn("_deletes", deleted)
    active = current.where("_is_current").select(*keys, F.col("_row_hash").alias("_old_hash"), F.col("_effective_from").alias("_old_from"), F.lit(True).alias("_known"))
    change = (
        F.when(F.col("_known").isNull(), F.when(F.col("_deletes"), F.lit("NONE")).otherwise(F.lit("NEW")))
        .when(F.col("_effective_from") < F.col("_old_from"), F.lit("LATE"))
        .when(F.col("_deletes"), F.lit("DELETED"))
        .when(~F.col("_row_hash").eqNullSafe(F.col("_old_hash")), F.lit("CHANGED"))
        .otherwise(F.lit("UNCHANGED"))
    )
    return join_keyed(batch, active, keys, "left").withColumn("_change", change).drop("_deletes", "_old_hash", "_old_from", "_known")


def change_counts(judged: DataFrame) -> DataFrame:
    """What a run did: rows that were new, changed (closed and added again) and unchanged."""
    return judged.agg(*[_count_change(kind) for kind in ("NEW", "CHANGED", "UNCHANGED")])


def all_change_counts(judged: DataFrame) -> DataFrame:
    """``change_counts``, and the rows that were late, deleted a version, or deleted nothing; they sum to ``batch_rows``."""
    return judged.agg(*[_count_change(kind) for kind in ("NEW", "CHANGED", "UNCHANGED", "LATE", "DELETED", "NONE")], F.count("*").alias("batch_rows"))


def _count_change(kind: str) -> Column:
    return F.count_if(F.col("_change") == kind).alias(f"{kind.lower()}_rows")


def apply(current: DataFrame | None, batch: DataFrame, keys: list[str], now: Column, close_at: str = "business", delete_when: Column | None = None) -> DataFrame:
    """The table after a versioned batch: changed versions closed, new and changed rows added.

    Rows of ``batch`` that ``delete_when`` holds for close the current version and add nothing.
    Unchanged rows, and rows that start before the current version (late ones, which
    ``all_change_counts`` reports and ``splice`` puts in their place), change nothing;
    applying a batch twice is applying it once.  Null keys are keys like others.
    """
    if current is None:
        return batch.where(~F.coalesce(delete_when, F.lit(False))) if delete_when is not None else batch
    # Closed versions never change: only the current part meets the batch.
    closed, active = current.where("not _is_current"), current.where("_is_current")
    judged = judge(current, batch, keys, delete_when)
    ends = judged.where("_change in ('CHANGED', 'DELETED')").select(*keys, (F.col("_effective_from") if close_at == "business" else now).alias("_end"), F.lit(True).alias("_closes"))
    closes = F.coalesce(F.col("_closes"), F.lit(False))
    kept = join_keyed(active, ends, keys, "left")
    kept = kept.withColumns({"_effective_to": F.when(closes, F.col("_end")).otherwise(F.col("_effective_to")), "_is_current": ~closes}).select(*current.columns)
    added = judged.where("_change in ('NEW', 'CHANGED')").drop("_change")
    return closed.unionByName(kept).unionByName(added, allowMissingColumns=True)


def from_log(df: DataFrame, keys: list[str], ts: str, exclude: tuple[str, ...] = (), rows_per_range: int | None = None) -> DataFrame:
    """All versions of a change log: runs of equal state collapse, each ends where the next begins.

    Rows of one time are ordered by their hash; all but the last of them hold for no time at all.
    """
    hashed = df.withColumn("_row_hash", row_hash(df, (ts, *exclude)))
    starts = chain(hashed, keys, ts, rows_per_range).where(~F.col("_repeats")).drop("_repeats")
    return starts.withColumns({"_effective_from": F.col(ts), "_is_current": F.col("_effective_to").isNull()}).select(*hashed.columns, "_effective_from", "_effective_to", "_is_current")


def chain(hashed: DataFrame, keys: list[str], ts: str, rows_per_range: int | None = None) -> DataFrame:
    """Hashed rows with ``_repeats`` (the state before is the same) and, for the others, ``_effective_to``: when the next one starts.

    One window a key, if no key has more than HOT_ROWS rows (a table that is small by Catalyst's
    estimate isn't counted).  With hotter keys, or with ``rows_per_range``, rows are dealt in order of
    key and time to ranges of about that many rows, and written so; a key can span many ranges then.
    What a range needs of others is one row each: the last row before it, and the first start after it.
    """
    if rows_per_range is None and not _estimate(hashed) <= SMALL_BYTES:
        largest = hashed.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        rows_per_range = HOT_ROWS if largest > HOT_ROWS else None
    if rows_per_range is None:
        by_time, back = Window.partitionBy(*keys).orderBy(ts, "_row_hash"), Window.partitionBy(*keys).orderBy(F.desc(ts), F.desc("_row_hash"))
        marked = hashed.withColumn("_repeats", F.col("_row_hash").eqNullSafe(F.lag("_row_hash").over(by_time)))
        # Going back in time, the last start so far is where a version ends.
        end = F.last(F.when(~F.col("_repeats"), F.struct(F.col(ts).alias("at"))), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
        return marked.withColumn("_effective_to", F.when(~F.col("_repeats"), end["at"]))
    number = max(1, -(-hashed.count() // rows_per_range))
    dealt = written(hashed.repartitionByRange(number, *keys, ts, "_row_hash").withColumn("_range", F.spark_partition_id()))
    place, key = F.struct(*keys, ts, "_row_hash"), F.struct(*keys)
    # Ranges follow each other, so these windows see one row a range.
    last = dealt.groupBy("_range").agg(F.max(place).alias("_last"))
    last = last.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_last"))
    in_range = Window.partitionBy("_range", *keys).orderBy(ts, "_row_hash")
    before = F.when(F.row_number().over(in_range) > 1, F.lag("_row_hash").over(in_range)).when(F.struct(*[F.col("_last")[k] for k in keys]).eqNullSafe(key), F.col("_last")["_row_hash"])
    marked = dealt.join(F.broadcast(last), "_range").withColumn("_repeats", F.col("_row_hash").eqNullSafe(before)).drop("_last")
    first = marked.where(~F.col("_repeats")).groupBy("_range").agg(F.min(place).alias("_first"))
    first = last.select("_range").join(first, "_range", "left")
    after = F.first("_first", ignorenulls=True).over(Window.orderBy("_range").rowsBetween(1, Window.unboundedFollowing))
    first = first.select("_range", after.alias("_first"))
    back = Window.partitionBy("_range", *keys).orderBy(F.desc(ts), F.desc("_row_hash")).rowsBetween(Window.unboundedPreceding, -1)
    end = F.last(F.when(~F.col("_repeats"), F.struct(F.col(ts).alias("at"))), ignorenulls=True).over(back)
    later = F.when(F.struct(*[F.col("_first")[k] for k in keys]).eqNullSafe(key), F.col("_first")[ts])
    marked = marked.join(F.broadcast(first), "_range").withColumn("_end", end)
    return marked.withColumn("_effective_to", F.when(~F.col("_repeats"), F.when(F.col("_end").isNotNull(), F.col("_end")["at"]).otherwise(later))).drop("_range", "_first", "_end")


def _estimate(df: DataFrame) -> int:
    """Bytes by Catalyst's statistics; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def splice(known: DataFrame | None, log: DataFrame, keys: list[str], ts: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """A spliced log after more of it, in any order: every arrival order gives what ``from_log`` gives of all rows.

    The result holds all observations once.  One that repeats the state before it is no version
    (``_repeats``), but it is kept: a late row before it can make it the start of one.  Only keys of
    ``log`` are built again; of rows that are equal in key, time and state one stays, so splicing a
    log twice is splicing it once.  ``spliced_versions`` gives the versions.
    """
    new = log.withColumn("_row_hash", row_hash(log, (ts, *exclude)))
    if known is not None:
        touched = log.select(*keys).distinct()
        untouched = join_keyed(known, touched, keys, "left_anti")
        again = join_keyed(known, touched, keys, "left_semi").drop("_is_current", "_effective_from", "_effective_to", "_repeats")
        new = again.unionByName(new, allowMissingColumns=True)
    point = [*keys, ts, "_row_hash"]
    new = latest_per_key(new, point, [F.col(c) for c in new.columns if c not in point]) if exclude else new.dropDuplicates(point)
    marked = chain(new, keys, ts).withColumns({"_effective_from": F.when(~F.col("_repeats"), F.col(ts)), "_is_current": ~F.col("_repeats") & F.col("_effective_to").isNull()})
    return untouched.unionByName(marked, allowMissingColumns=True) if known is not None else marked


def spliced_versions(spliced: DataFrame) -> DataFrame:
    """The versions among a spliced log's observations."""
    return spliced.where(~F.col("_repeats")).drop("_repeats")


def as_of(df: DataFrame, at: Column) -> DataFrame:
    return df.where((F.col("_effective_from") <= at) & (F.col("_effective_to").isNull() | (F.col("_effective_to") > at)))


def key_history(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition).orderBy("_effective_from")


def summary(df: DataFrame) -> DataFrame:
    """Current, historical and total versions in one pass."""
    return df.agg(F.count_if("_is_current").alias("current_rows"), F.count_if(~F.col("_is_current")).alias("historical_rows"), F.count("*").alias("total_rows"))
