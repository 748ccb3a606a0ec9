"""Bronze and silver loads of one table: what a spec asks for, written to the layer's folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, scd2, standardize
from . import control, ingest, sinks
from .tables import TableSpec


def table_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def load_bronze(source: DataFrame, path: str, spec: TableSpec, system: str, run_id: str, at: Column, force: bool = False) -> tuple[str, int]:
    """Historical: replace the table. Incremental: append what is newer than its mark; nothing new, no write.

    Returns (kind, rows loaded); rows are counted by the pass that writes them.
    """
    spark = source.sparkSession
    target = sinks.read_merged(spark, path) if table_exists(spark, path) else None
    kind, batch = "historical", source
    if spec.load_type == "incremental" and spec.watermark:
        batch, kind = ingest.incremental_batch(source, target, spec.watermark, force)
    batch = ingest.stamp_audit(batch, system, spec.source_table, kind, run_id, at)
    if kind != "historical" and batch.isEmpty():
        return kind, 0
    write = sinks.overwrite if kind == "historical" else sinks.append
    _, seen = quality.checked_write(batch, lambda df: write(df, path))
    return kind, seen["rows"]


def load_bronze_marked(source: DataFrame, path: str, control_path: str, spec: TableSpec, system: str, run_id: str, at: Column, checks: dict | None = None, force: bool = False) -> tuple[str, DataFrame]:
    """An incremental load by the mark in the control table, so that the target isn't read at all; (kind, checks of the rows written).

    One pass reads the source, writes its rows after the mark and observes their number, their largest
    mark and the checks (arguments of ``quality.checked_write``).  What it saw is committed as the
    run's control row: SUCCESS, or FAILED with the old mark if a check fails; then its rows are put
    aside in a hidden folder, as the next run loads them again.  Each run writes the folder of its
    id, and a run that is repeated replaces it; a historical one replaces all others.
    """
    spark = source.sparkSession
    key = (spec.target_table, "bronze")
    mark = None if force else ingest.last_watermark(control.read(spark, control_path), *key)
    kind = ingest.choose_load(spec.load_type, spec.watermark, mark is not None, mark, force)
    batch = ingest.stamp_audit(ingest.since(source, spec.watermark, mark) if kind == "incremental" else source, system, spec.source_table, kind, run_id, at)
    into = f"{path.rstrip('/')}/_run={run_id}"
    checks = {"min_rows": 0} | (checks or {})
    result, seen = quality.checked_write(batch, lambda df: sinks.overwrite(df, into), **checks, more={"_mark": F.max(spec.watermark).cast("timestamp_ntz")} if spec.watermark else {})
    good = all(r["passed"] for r in result.collect())  # a row a check
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = where(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not good:
        files.delete(where(path, f".failed-{run_id}"), True)
        files.rename(where(into), where(path, f".failed-{run_id}"))
    elif kind == "historical":
        for other in files.listStatus(where(path)):
            if other.getPath().getName().startswith("_run=") and other.getPath().getName() != f"_run={run_id}":
                files.delete(other.getPath(), True)
    row = (*key, seen.get("_mark"), "SUCCESS" if good else "FAILED", spark.range(1).select(at.cast("timestamp_ntz")).first()[0], seen["rows"], run_id)
    control.commit(spark, control_path, spark.createDataFrame([row], ingest.CONTROL))
    return kind, result


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """What all runs of ``load_bronze_marked`` have written."""
    return sinks.read_merged(spark, path).drop("_run")


def silver_state(bronze: DataFrame, current: DataFrame | None, spec: TableSpec, from_col: str | None, now: Column) -> DataFrame:
    """The silver table after a batch of bronze rows.

    Names are cleaned (audit columns keep theirs), keys and order columns trimmed where they are
    text. Historical loads replace everything with current versions from ``now``; incremental SCD2
    loads apply the batch; other incremental loads append it. Audit columns don't count as content.
    """
    clean, _ = standardize.clean_names(bronze.drop(*[c for c in ingest.AUDIT if c in bronze.columns]))
    spec.validate(clean.columns)
    text = [c for c in (*spec.keys, *spec.order_by) if dict(clean.dtypes)[c] == "string"]
    clean = standardize.trim_columns(clean, text) if text else clean
    # A total order, so that reruns keep the same row of a key.
    order = [*[F.desc_nulls_last(c) for c in spec.order_by], *[F.col(c) for c in sorted(clean.columns)]]
    if spec.load_type != "incremental":
        return scd2.backfill_versions(scd2.latest_per_key(clean, list(spec.keys), order) if spec.keys else clean.dropDuplicates(), now)
    if spec.strategy == "scd2":
        batch = scd2.versioned(clean, list(spec.keys), from_col or spec.order_by[0], order, now)
        return scd2.apply(current, batch, list(spec.keys), now)
    return clean if current is None else current.unionByName(clean, allowMissingColumns=True)


def write_silver(state: DataFrame, folder: str) -> str:
    """A new version of the table next to the old ones, so that readers of those aren't disturbed; its path."""
    path = f"{folder}/version={uuid.uuid4().hex}"
    sinks.overwrite(state, path)
    return path


def validate_silver(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Counts of both layers and the version columns that are missing, one row."""
    missing = ",".join(c for c in scd2.VERSION if c not in silver.columns)
    both = bronze.select(F.lit(1).alias("b"), F.lit(0).alias("s")).unionAll(silver.select(F.lit(0), F.lit(1)))
    return both.agg(F.sum("b").alias("bronze_rows"), F.sum("s").alias("silver_rows")).withColumn("missing", F.lit(missing))
