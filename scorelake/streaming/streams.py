"""Structured Streaming forms of ingestion, SCD2 and the daily inference profile."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import scd2
from ..operators.joins import join_keyed
from ..sources import generations


def file_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def ingest_available(stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Append everything new and stop; the checkpoint is the high-water mark."""
    query = transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def scd2_available(stream: DataFrame, state: str, checkpoint: str, keys: list[str], from_col: str) -> None:
    """Apply every micro-batch that is there to the versioned table under ``state``; read it by ``scd2_table``.

    Batch n reads the current versions that batch n-1 left and overwrites ``batch=n``: the versions
    that it closed and the current ones.  Closed versions of earlier batches are neither read nor
    written again, and a batch that runs again gives the same files.  Batches must come in the
    order of ``from_col`` per key: a row before its key's current version is an error, as it would
    give wrong intervals (``scd2_any_order`` takes rows in any order).
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        current = spark.read.parquet(f"{state}/batch={number - 1}").where("_open = 1").drop("_open") if number else None
        # The log of a batch becomes versions first, so that changes inside it aren't lost.
        versions = scd2.from_log(batch, keys, from_col)
        if current is not None:
            late = scd2.judge(current, versions, keys).where("_change = 'LATE'").select(*keys, from_col).first()
            if late:
                raise ValueError(f"batch {number}: a row comes after a later one of its key: {late.asDict()}")
        table = merge_log(current, versions, keys) if current is not None else versions
        table.withColumn("_open", F.col("_is_current").cast("int")).write.mode("overwrite").partitionBy("_open").parquet(f"{state}/batch={number}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def scd2_any_order(stream: DataFrame, state: str, checkpoint: str, keys: list[str], from_col: str, buckets: int = generations.BUCKETS) -> None:
    """Splice every micro-batch that is there into the table under ``state``, rows in any order; read it by ``spliced_table``.

    Batch n is generation n of a table in buckets of keys: it reads and writes the buckets that its
    keys fall into, and a batch that runs again gives the same files.
    """

    def step(batch: DataFrame, number: int) -> None:
        generations.merge(batch.sparkSession, state, batch, keys, lambda old, log: scd2.splice(old, log, keys, from_col), number, buckets)

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def spliced_table(spark: SparkSession, state: str) -> DataFrame:
    """All versions of a table that ``scd2_any_order`` keeps."""
    return scd2.spliced_versions(generations.read(spark, state))


def scd2_table(spark: SparkSession, state: str) -> DataFrame:
    """All versions: what each batch closed, and what the last one left current."""
    every = spark.read.parquet(state)
    last = every.agg(F.max("batch")).first()[0]
    return every.where((F.col("_open") == 0) | (F.col("batch") == last)).drop("_open", "batch")


def merge_log(current: DataFrame, versions: DataFrame, keys: list[str]) -> DataFrame:
    """Add later versions to a versioned table: the first one ends the current one unless it is the same state."""
    first = scd2.latest_per_key(versions, keys, [F.col("_effective_from"), F.col("_effective_to").asc_nulls_last(), F.col("_row_hash")])
    heads = first.select(*keys, F.col("_row_hash").alias("_first_hash"), F.col("_effective_from").alias("_first_from"), F.col("_effective_to").alias("_first_to"))
    joined = join_keyed(current, heads, keys, "left")
    same = F.col("_is_current") & (F.col("_row_hash") == F.col("_first_hash"))
    ends = F.col("_is_current") & F.col("_first_hash").isNotNull()
    kept = joined.withColumn("_effective_to", F.when(same, F.col("_first_to")).when(ends, F.col("_first_from")).otherwise(F.col("_effective_to")))
    kept = kept.withColumn("_is_current", F.col("_effective_to").isNull()).select(*current.columns)
    active = current.where("_is_current").select(*keys, F.col("_row_hash").alias("_old_hash"))
    place = [*keys, "_effective_from", "_row_hash"]
    continued = join_keyed(first, active, keys).where("_row_hash = _old_hash").select(*place)
    return kept.unionByName(join_keyed(versions, continued, place, "left_anti").select(*current.columns))


def daily_profile(stream: DataFrame, ts: str, late: str = "2 days") -> DataFrame:
    """Rows, distinct-free sums per day with late data up to ``late``; append mode closes days."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.to_date("w.start").alias("day"), "event_type", "n", "total")
    )


def profile_with_late(stream: DataFrame, state: str, checkpoint: str, ts: str, late: str = "2 days") -> None:
    """``daily_profile`` of every micro-batch that is there, with the rows that come behind the watermark kept aside.

    The watermark of a batch is the latest time of all batches before it, less ``late``, and a day is
    closed once it has ended by the watermark; a watermarked aggregate drops rows of closed days
    without a trace.  Batch n overwrites its own folders: ``open``, the sums of days still open
    (those of batch n-1 and its own rows); ``closed``, the days that it closes; and ``late``, its rows of closed
    days.  So a batch that runs again gives the same files, only open days are read and written again,
    and closed days, late rows and open days always add up to the input.  Rows without a time are late.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.parquet(f"{state}/open/batch={number - 1}") if number else None
        # A row of its own holds the latest time, so that it outlives the days that close.
        last = before.where("day is null").first()["latest"] if number else None
        mark = F.lit(last).cast("timestamp") - F.expr(f"interval {late}") if last is not None else F.lit(None).cast("timestamp")
        over = lambda day: F.coalesce(F.date_add(day, 1).cast("timestamp") <= mark, F.lit(False))
        rows = batch.withColumn("_late", over(F.to_date(ts)) | F.col(ts).isNull())
        rows.where("_late").drop("_late").write.mode("overwrite").parquet(f"{state}/late/batch={number}")
        own = rows.where("not _late").groupBy(F.to_date(ts).alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max(ts).alias("latest"))
        sums = own if before is None else own.unionByName(before.where("day is not null"))
        sums = sums.groupBy("day", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("latest").alias("latest"))
        staged = f"{state}/sums/batch={number}"
        sums.write.mode("overwrite").parquet(staged)
        sums = spark.read.parquet(staged)  # a row a day and type
        newest = sums.agg(F.max("latest")).first()[0]
        newest = max((t for t in (newest, last) if t is not None), default=None)
        closing = F.coalesce(F.date_add("day", 1).cast("timestamp") <= F.lit(newest).cast("timestamp") - F.expr(f"interval {late}"), F.lit(False))
        sums.where(closing).drop("latest").write.mode("overwrite").parquet(f"{state}/closed/batch={number}")
        note = spark.createDataFrame([(None, None, None, None, newest)], sums.schema)
        sums.where(~closing).unionByName(note).write.mode("overwrite").parquet(f"{state}/open/batch={number}")

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def profile_parts(spark: SparkSession, state: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(closed days, late rows, open days) of a table that ``profile_with_late`` keeps."""
    opened = spark.read.parquet(f"{state}/open")
    last = opened.agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{state}/closed").drop("batch"), spark.read.parquet(f"{state}/late").drop("batch"), opened.where((F.col("batch") == last) & F.col("day").isNotNull()).drop("batch", "latest")
