"""Ranges of rows by (id, hash), so that rows of one id are split too; one range is one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands in for a null id: the smallest.
NO_ID = -(2**63)
#: More tasks than this don't run any sooner; beyond it ranges grow and are streamed all the same.
MOST_RANGES = 100_000
SAMPLES = 20


def cut_points(rows: DataFrame, rows_per_range: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, hash) of the cuts between ranges of about ``rows_per_range`` rows of ``rows`` (id, hash; both long, not null).

    They come from some SAMPLES distinct pairs a range, those whose hashes are smallest, with their
    numbers of rows: a bounded table that depends on the data alone.
    """
    total = rows.count()
    ranges = min(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // rows_per_range), MOST_RANGES)
    share = min(1.0, SAMPLES * ranges / max(total, 1))
    slot = F.pmod(F.xxhash64("id", "hash"), F.lit(1 << 31))
    sample = rows.where(slot < int(share * (1 << 31))).groupBy("id", "hash").agg(F.count("*").alias("n")).toPandas().sort_values(["id", "hash"])
    upto = sample["n"].to_numpy().cumsum()
    if not len(upto) or ranges < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.unique(np.minimum(np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges), len(upto) - 1))
    return sample["id"].to_numpy(np.int64)[at], sample["hash"].to_numpy(np.int64)[at]


def range_number(id: Column, hash: Column, cuts: tuple[np.ndarray, np.ndarray]) -> Column:
    """How many cuts are at or before (id, hash): from 0 to the number of cuts."""
    ids, hashes = cuts

    @F.pandas_udf("int")
    def number(one: pd.Series, two: pd.Series) -> pd.Series:
        a, b = one.to_numpy(np.int64), two.to_numpy(np.int64)
        low, high = np.searchsorted(ids, a), np.searchsorted(ids, a, "right")
        for i in np.flatnonzero(high > low):  # ids that are cuts
            low[i] += np.searchsorted(hashes[low[i] : high[i]], b[i], "right")
        return pd.Series(low.astype(np.int32))

    return number(id, hash)
