"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are put in order of ``doc_id`` over range partitions and written once with their partition's
number.  The partitions' totals (one row a partition) give each partition's offset, a running sum
inside the partition gives the rest, and a row goes to the shard that the middle of its bytes falls
into.  Only ids, sizes and checksums are sorted; texts aren't moved.

Null texts have no bytes (a size of 1); null ids come first; rows of equal id are ordered by
checksum and size, and rows equal in those are interchangeable.  An empty table gives no rows.
Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import materialise

SHARDS = 16
ROWS_PER_PARTITION = 1_000_000


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    # Partitions grow in number with the rows; the session's width is the least.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.count() // rows_per_partition)
    ordered = slim.repartitionByRange(parts, "doc_id", "text_crc32", "size").withColumn("part", F.spark_partition_id())
    rows = materialise(ordered, "sharding-order")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select("part", F.coalesce(F.sum("bytes").over(whole), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("rows").over(whole), F.lit(0)).alias("rows_before"))
    )
    total = rows.agg(F.sum("size")).first()[0] or 1
    inside = Window.partitionBy("part").orderBy("doc_id", "text_crc32", "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        # One row a partition: small by their number.
        rows.withColumns({"_upto": F.sum("size").over(upto), "_nth": F.row_number().over(inside)})
        .join(F.broadcast(totals), "part")
        .withColumn("_index", F.col("rows_before") + F.col("_nth") - 1)
        .withColumn("shard", F.expr(f"cast(least({shards - 1}, (2 * (bytes_before + _upto) - size) * {shards} div (2 * {total})) as int)"))
    )
    placed = materialise(placed.select("doc_id", "size", "text_crc32", "shard", "_index"), "sharding-placed")
    starts = placed.groupBy("shard").agg(F.min("_index").alias("_first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_index") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
