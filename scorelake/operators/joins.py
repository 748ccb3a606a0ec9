"""Joins on keys that can be null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keyed(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join by name in which null is a key like others; ``left``'s keys stay."""
    renamed = {k: f"_right_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(renamed)
    on = [F.col(f"_left.`{k}`").eqNullSafe(F.col(f"_right.`{r}`")) for k, r in renamed.items()]
    return left.alias("_left").join(right.alias("_right"), on, how).drop(*renamed.values())
