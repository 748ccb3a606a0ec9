"""Incremental ingestion: audit columns, high-water marks and the control table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import upsert

# The names of the audit and control columns.
AUDIT = ["_ingested_at", "_source_system", "_source_table", "_load_type", "_ingestion_id"]
CONTROL = (
    "table_name string, layer string, last_processed_watermark timestamp_ntz, last_run_status string, last_run_timestamp timestamp_ntz, rows_processed long, run_id string"
)


def stamp_audit(df: DataFrame, system: str, table: str, kind: str, run_id: str, at: Column) -> DataFrame:
    """Clock and run id are arguments, so a run can be repeated."""
    return df.withColumns({"_ingested_at": at, "_source_system": F.lit(system), "_source_table": F.lit(table), "_load_type": F.lit(kind), "_ingestion_id": F.lit(run_id)})


def high_water_mark(df: DataFrame, column: str):
    """The largest value so far; None for an empty table."""
    return df.agg(F.max(column)).first()[0]


def since(df: DataFrame, column: str, mark, overlap: bool = False) -> DataFrame:
    """Rows after the mark; with ``overlap`` also those at it (drop known ones by hash). No mark: all."""
    if mark is None:
        return df
    return df.where(F.col(column) >= F.lit(mark) if overlap else F.col(column) > F.lit(mark))


def choose_load(load_type: str, watermark: str | None, target_exists: bool, mark, force: bool = False) -> str:
    """``incremental`` only with a watermark column, a target, a mark, and no force."""
    return "incremental" if load_type == "incremental" and watermark and target_exists and mark is not None and not force else "historical"


def incremental_batch(source: DataFrame, target: DataFrame | None, watermark: str, force: bool = False) -> tuple[DataFrame, str]:
    """What a run has to load, and how. An empty batch means that nothing is to be written."""
    mark = None if target is None or force else high_water_mark(target, watermark)
    kind = choose_load("incremental", watermark, target is not None, mark, force)
    return (since(source, watermark, mark) if kind == "incremental" else source), kind


def bronze_check(df: DataFrame) -> DataFrame:
    """Row count and missing audit columns, one row."""
    missing = [c for c in AUDIT if c not in df.columns]
    return df.agg(F.count("*").alias("rows")).withColumn("missing", F.lit(",".join(missing)))


def empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CONTROL)


def last_watermark(control: DataFrame, table: str, layer: str):
    """The last good mark. A failed run keeps it, so nothing is loaded twice."""
    row = control.where((F.col("table_name") == table) & (F.col("layer") == layer)).select("last_processed_watermark").first()
    return row[0] if row else None


def last_watermarks(control: DataFrame, tables: DataFrame, layer: str) -> DataFrame:
    """(table_name, mark) of all ``tables`` by one join; the mark is null where no run of the table was good."""
    marks = control.where(F.col("layer") == layer).select("table_name", F.col("last_processed_watermark").alias("mark"))
    return tables.select("table_name").distinct().join(marks, "table_name", "left")


def next_control(control: DataFrame, runs: DataFrame) -> DataFrame:
    """The control table after ``runs`` (its columns, a row a table and layer).

    A success moves the mark (a null mark keeps the old one); a failure keeps mark and rows and
    notes status, time and run; a failed first run leaves no row.
    """
    keys = ["table_name", "layer"]
    old = control.select(*keys, F.col("last_processed_watermark").alias("_mark"), F.col("rows_processed").alias("_rows"), F.lit(True).alias("_known"))
    joined = runs.join(old, keys, "left")
    good = F.col("last_run_status") == "SUCCESS"
    changes = joined.where(good | F.col("_known")).select(
        *keys,
        F.coalesce(F.when(good, F.col("last_processed_watermark")), F.col("_mark")).alias("last_processed_watermark"),
        "last_run_status", "last_run_timestamp",
        F.when(good, F.col("rows_processed")).otherwise(F.col("_rows")).alias("rows_processed"), "run_id",
    )
    return upsert(control, changes, keys).select(*[c.split()[0] for c in CONTROL.split(", ")])


def control_status(control: DataFrame) -> DataFrame:
    return control.orderBy("layer", "table_name")
