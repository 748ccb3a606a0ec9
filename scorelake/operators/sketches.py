"""Monitoring by day: mergeable sketches of each day's scores and values, and metrics of any window from merging them.

A run reads its own day and writes that day's folder, so a day that is run again replaces itself and
no run reads an earlier day's rows.  Distinct counts come from HyperLogLog, ranks and quantiles from
KLL sketches; both are Spark's own aggregates and merge without loss.  Exact forms are
``metrics.roc_metrics``, ``metrics.psi`` and ``count_distinct``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from . import metrics

#: KLL's size: ranks are off by some 0.3 % of a window's rows (normal error at 99 %), whatever their number.
KLL_K = 1000
#: HyperLogLog's registers as a power of two: a relative standard error of 0.8 %.
HLL_BITS = 14
#: Values that stand for a class when two score distributions are compared.
GRID = 250


def distinct_sketches(df: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """(day, column_name, rows, sketch): distinct values of each column by day, in one pass."""
    one = df.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("rows"), *[F.hll_sketch_agg(F.col(c).cast("string"), HLL_BITS).alias(f"_{i}") for i, c in enumerate(columns)])
    return one.select("day", "rows", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("sketch")) for i, c in enumerate(columns)])))


def distinct_between(sketches: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """(column_name, rows, estimate) of the days from ``first`` to ``last``."""
    days = sketches.where(F.col("day").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))
    return days.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def score_sketches(df: DataFrame, ts: str, by: list[str], score: str) -> DataFrame:
    """(day, by ..., n, sketch): the distribution of scores by day and group; null scores aren't counted."""
    rows = df.where(F.col(score).isNotNull())
    return rows.groupBy(F.to_date(ts).alias("day"), *by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(score).cast("double"), KLL_K).alias("sketch"))


def merged(sketches: DataFrame, by: list[str], first: str | date, last: str | date) -> DataFrame:
    """(by ..., n, sketch) of a window of days."""
    days = sketches.where(F.col("day").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))
    return days.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"))


def window_quantiles(window: DataFrame, shares: list[float]) -> DataFrame:
    """A window's groups with ``quantiles`` at ``shares``."""
    return window.withColumn("quantiles", _quantiles(F.col("sketch"), shares)).drop("sketch")


def _quantiles(sketch: Column, shares: list[float]) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, shares)))


def window_roc(window: DataFrame, label: str, by: list[str]) -> DataFrame:
    """n, auc, gini and ks per group, from a window by ``[*by, label]``; null where one class is missing.

    Each class is taken as GRID values of equal weight, the middles of its quantiles.
    """
    of = lambda v, c: F.max_by(c, F.when(F.col(label) == v, 1))
    pairs = window.groupBy(*by).agg(F.sum(F.when(F.col(label).isin(0, 1), F.col("n"))).alias("n"), of(1, "sketch").alias("_one"), of(0, "sketch").alias("_zero"), F.max(F.col(label) == 1).alias("_has_one"), F.max(F.col(label) == 0).alias("_has_zero"))
    both = F.coalesce(F.col("_has_one") & F.col("_has_zero"), F.lit(False))
    middles = [(i + 0.5) / GRID for i in range(GRID)]
    pairs = pairs.withColumns({"_p": F.when(both, _quantiles(F.col("_one"), middles)), "_n": F.when(both, _quantiles(F.col("_zero"), middles))})
    upto = lambda values, x: F.size(F.filter(values, lambda v: v <= x))
    under = lambda values, x: F.size(F.filter(values, lambda v: v < x))
    wins = F.aggregate(F.transform("_p", lambda x: upto("_n", x) + under("_n", x)), F.lit(0).cast("long"), lambda a, x: a + x)
    gap = F.array_max(F.transform(F.concat("_p", "_n"), lambda x: upto("_n", x) - upto("_p", x)))
    pairs = pairs.withColumns({"_auc": F.when(both, wins / F.lit(2.0 * GRID * GRID)), "_ks": F.when(both, F.greatest(gap, F.lit(0)) / F.lit(float(GRID)))})
    return pairs.select(*by, "n", F.round("_auc", 4).alias("auc"), F.round(2 * F.col("_auc") - 1, 4).alias("gini"), F.round("_ks", 4).alias("ks"))


def window_psi(window: DataFrame, group: str, baseline: str, bins: int = 10) -> DataFrame:
    """(group, psi, alert_level) of a window's groups against the baseline's, in bins of one width between the baseline's extremes."""
    base = window.where(F.col(group) == baseline)
    ends = base.select(_quantiles(F.col("sketch"), [0.0, 1.0]).alias("ends")).first()
    if ends is None:
        return window.select(F.col(group), F.lit(None).cast("double").alias("psi"), F.lit(None).cast("string").alias("alert_level")).limit(0)
    low, high = ends["ends"]
    low, high = (low - 0.5, high + 0.5) if low == high else (low, high)
    # A value at the lowest edge is inside: what is below is the share up to a point just under it.
    edges = [low - abs(low) * 1e-12 - 1e-300, *[low + (high - low) * i / bins for i in range(1, bins)], high]
    upto = F.kll_sketch_get_rank_double("sketch", F.array(*[F.lit(float(e)) for e in edges]))
    counted = window.select(group, F.col("n").alias("_n"), upto.alias("_upto"))
    counted = counted.withColumn("_c", F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.col("_n") * (F.col("_upto")[i] - F.col("_upto")[i - 1])))
    total = F.aggregate("_c", F.lit(0.0), lambda a, x: a + x)
    shares = counted.select(group, F.transform("_c", lambda c: (c + 0.5) / (total + 0.5)).alias("share"))
    expected = shares.where(F.col(group) == baseline).select(F.col("share").alias("expected"), F.lit(1).alias("_k"))
    both = shares.where(F.col(group) != baseline).withColumn("_k", F.lit(1)).join(F.broadcast(expected), "_k")  # one row
    psi = F.aggregate(F.zip_with("share", "expected", lambda a, e: (a - e) * F.ln(a / e)), F.lit(0.0), lambda s, x: s + x)
    return both.select(group, F.round(psi, 4).alias("psi")).withColumn("alert_level", metrics.alert(F.col("psi")))


def write_day(sketches: DataFrame, path: str, day: str | date) -> None:
    """Store one day's sketches; a day that is written again replaces itself only."""
    sinks.overwrite(sketches.where(F.col("day") == F.lit(str(day)).cast("date")).drop("day"), f"{path.rstrip('/')}/day={day}")


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
