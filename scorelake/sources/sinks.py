"""Sinks: full overwrite, append, create-or-append, write-once and keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.joins import join_keyed


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace data and schema."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows, creating the table if it isn't there; new columns show when read with ``read_merged``."""
    df.write.mode("append").parquet(path)


def write_once(df: DataFrame, path: str) -> None:
    """Keep what is there."""
    df.write.mode("ignore").parquet(path)


def read_merged(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """The next state of a keyed table: changes replace rows of the same key, other rows stay.

    Null keys are keys like others.  Write it under a new path; plain files have no row updates.
    """
    return join_keyed(current, changes.select(*keys), keys, "left_anti").unionByName(changes, allowMissingColumns=True)
