"""Column names, schemas and text forms."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_name(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]", "_", name)).strip("_").lower()


def clean_names(df: DataFrame, reserved: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, str]]:
    """Letters, digits and single underscores in lower case; ``reserved`` columns keep their name."""
    renames = {c: c if c in reserved else clean_name(c) for c in df.columns}
    if len(set(renames.values())) < len(renames):
        raise ValueError(f"names collide: {sorted(renames.values())}")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in renames.items()]), renames


def apply_renames(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(renames)


def keep_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that there are, in that order."""
    return df.select(*[c for c in wanted if c in df.columns])


def trim_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns})


def hex_binary(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.hex(f.name) for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)})


def parse_timestamp(text: Column, formats: tuple[str, ...]) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def align_schema(df: DataFrame, schema: T.StructType, formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy")) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null, dates and times parsed, others cast (null where impossible)."""
    have = dict(df.dtypes)
    out = []
    for f in schema.fields:
        if f.name not in have:
            column = F.lit(None).cast(f.dataType)
        elif have[f.name] == f.dataType.simpleString():
            column = F.col(f.name)
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType)) and have[f.name] == "string":
            column = parse_timestamp(F.col(f.name), formats).cast(f.dataType)
        else:
            column = F.col(f.name).try_cast(f.dataType)
        out.append(column.alias(f.name))
    return df.select(*out)


def union_history(batch: DataFrame, history: DataFrame, operation: str = "HISTORY") -> DataFrame:
    """Add a history table to a batch; rows without ``_operation`` get a synthetic one."""
    if "_operation" not in history.columns:
        history = history.withColumn("_operation", F.lit(operation))
    if "_operation" not in batch.columns:
        batch = batch.withColumn("_operation", F.lit("UPSERT"))
    return batch.unionByName(history, allowMissingColumns=True)
