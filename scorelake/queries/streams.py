"""Streaming forms; each gives the rows of its batch query, read from files written for the stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import load
from ..streaming import streams
from . import query
from .folders import shared_folder
from .history import LOG_SQL, SQL_COLUMNS, VERSION_COLUMNS, states


def _arrivals(df: DataFrame, folder: str, ts: str, parts: int) -> Iterator[DataFrame]:
    """Write the table in ``parts`` slices of time, each by many tasks, and give a stream over the folder after each."""
    spark = df.sparkSession
    cuts = df.agg(F.percentile_approx(F.unix_micros(F.col(ts).cast("timestamp")), [i / parts for i in range(1, parts)])).first()[0]
    number = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.unix_micros(F.col(ts).cast("timestamp"))))
    for i in range(parts):
        df.where(number == i).write.mode("append").parquet(folder)
        yield streams.file_stream(spark, folder, df.schema)


@query("select event_id, user_id, event_type from events")
def stream_ingest(spark, sf_dir):
    folder = shared_folder(spark)
    source = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    for stream in _arrivals(source, f"{folder}/in", "ts", 3):
        for _ in range(2):  # the second run finds nothing new
            streams.ingest_available(stream, f"{folder}/out", f"{folder}/checkpoint", lambda df: df.drop("ts"))
    return spark.read.parquet(f"{folder}/out")


@query(LOG_SQL + f"select {SQL_COLUMNS} from log")
def stream_scd2(spark, sf_dir):
    folder = shared_folder(spark)
    for stream in _arrivals(states(spark, sf_dir), f"{folder}/in", "ts", 4):
        streams.scd2_available(stream, f"{folder}/state", f"{folder}/checkpoint", ["user_id"], "ts")
    return streams.scd2_table(spark, f"{folder}/state").select(*[F.col(c).cast("double").alias(c) if c == "value" else c for c in VERSION_COLUMNS])


@query(LOG_SQL + f"select {SQL_COLUMNS} from log")
def stream_scd2_late(spark, sf_dir):
    """The events come in slices by a hash, so most of a slice's rows are earlier than what is there."""
    folder = shared_folder(spark)
    rows = states(spark, sf_dir)
    for i in range(3):
        rows.where(F.pmod(F.xxhash64("user_id", "ts"), F.lit(3)) == i).write.mode("append").parquet(f"{folder}/in")
        streams.scd2_any_order(streams.file_stream(spark, f"{folder}/in", rows.schema), f"{folder}/state", f"{folder}/checkpoint", ["user_id"], "ts", 16)
    return streams.spliced_table(spark, f"{folder}/state").select(*[F.col(c).cast("double").alias(c) if c == "value" else c for c in VERSION_COLUMNS])


@query("select cast(ts as date) as day, event_type, count(*) as n, round(sum(value), 4) as total from events where cast(ts as date) < (select max(cast(ts as date)) - 2 from events) group by all")
def stream_profile(spark, sf_dir):
    """Days that the watermark has closed; late rows within it are counted."""
    folder = shared_folder(spark)
    rows = load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    last_day = rows.agg(F.max(F.to_date("ts"))).first()[0]
    for stream in _arrivals(rows, f"{folder}/in", "ts", 3):
        streams.ingest_available(streams.daily_profile(stream, "ts"), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").where(F.col("day") < F.date_sub(F.lit(last_day), 2)).select("day", "event_type", "n", F.round("total", 4).alias("total"))


@query("select cast(ts as date) as day, event_type, count(*) as n, round(sum(value), 4) as total, true as some_closed, true as some_late from events group by 1, 2")
def stream_profile_late(spark, sf_dir):
    """Slices of time, and a tenth of all rows, taken by a hash, in a last slice of their own: closed days, late rows and open days add up to the input."""
    folder = shared_folder(spark)
    rows = load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    held = F.pmod(F.xxhash64("ts", "value"), F.lit(10)) == 0
    for stream in _arrivals(rows.where(~held), f"{folder}/in", "ts", 3):
        streams.profile_with_late(stream, f"{folder}/state", f"{folder}/checkpoint", "ts")
    rows.where(held).write.mode("append").parquet(f"{folder}/in")
    streams.profile_with_late(streams.file_stream(spark, f"{folder}/in", rows.schema), f"{folder}/state", f"{folder}/checkpoint", "ts")
    closed, late, opened = streams.profile_parts(spark, f"{folder}/state")
    late = late.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    some = closed.agg((F.count("*") > 0).alias("some_closed")).first()[0], late.agg((F.count("*") > 0).alias("some_late")).first()[0]
    parts = closed.unionByName(late).unionByName(opened).groupBy("day", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))
    return parts.select("*", F.lit(some[0]).alias("some_closed"), F.lit(some[1]).alias("some_late"))
