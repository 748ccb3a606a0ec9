"""Weight of evidence, information value and feature selection over all features at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .ranges import running_sums

OTHER = "Other"
EXCLUDE_BELOW, WEAK_BELOW = 0.02, 0.10


def long_form(df: DataFrame, features: list[str], target: str, kind: str) -> DataFrame:
    """(feature, value, target) rows without null values, one scan for all features."""
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in features]
    return df.select(F.col(target).cast("int").alias("target"), F.inline(F.array(*items))).where("value is not null")


def count_values(long: DataFrame) -> DataFrame:
    """(feature, value, n, good, bad): rows of each value, all, of target 0 and of 1; written once, for everything that bands need."""
    return written(long.groupBy("feature", "value").agg(F.count("*").alias("n"), F.count_if(F.col("target") == 0).alias("good"), F.count_if(F.col("target") == 1).alias("bad")))


def quantiles(long: DataFrame, shares: list[float]) -> DataFrame:
    """Per feature, the exact quantiles of ``value`` (between neighbours by their distance), as ``points``."""
    return counted_quantiles(count_values(long), shares)


def counted_quantiles(counted: DataFrame, shares: list[float]) -> DataFrame:
    """``quantiles`` from the counts of values; their ranks come in two levels, so no task orders all values of a feature."""
    ranked = running_sums(counted, ["feature"], ["value"], ["n"])
    found, points = [], []
    for i, share in enumerate(shares):
        at = F.lit(share) * (F.col("_all_n") - 1)
        holds = lambda rank: (rank >= F.col("_upto_n") - F.col("n")) & (rank < F.col("_upto_n"))
        found += [F.max(F.when(holds(F.floor(at)), F.col("value"))).alias(f"_low{i}"), F.max(F.when(holds(F.ceil(at)), F.col("value"))).alias(f"_high{i}")]
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        points.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high))
    rows = ranked.groupBy("feature").agg(F.first("_all_n").alias("_all_n"), *found)
    return rows.select("feature", F.array(*points).alias("points"))


def quantile_edges(long: DataFrame, bins: int = 10) -> DataFrame:
    """Per feature, distinct quantile edges; a feature of one value, which has no quantile bands, gets bands of one width."""
    return counted_edges(count_values(long), bins)


def counted_edges(counted: DataFrame, bins: int = 10) -> DataFrame:
    edges = counted_quantiles(counted, [i / bins for i in range(bins + 1)]).select("feature", F.array_sort(F.array_distinct("points")).alias("edges"))
    # With fewer than two edges all of the feature's values are one.
    one = F.struct(F.col("edges")[0].alias("low"), F.col("edges")[0].alias("high"), F.lit(1).alias("n"))
    return edges.select("feature", F.when(F.size("edges") < 2, width_edges(one["low"], one["high"], one["n"], bins)).otherwise(F.col("edges")).alias("edges"))


def equal_width_edges(long: DataFrame, bins: int = 10) -> DataFrame:
    """Per feature, ``min(bins, max(distinct, 2))`` bands of one width."""
    shape = long.groupBy("feature").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count_distinct("value").alias("n"))
    return shape.select("feature", width_edges(F.col("low"), F.col("high"), F.col("n"), bins).alias("edges"))


def width_edges(low: Column, high: Column, distinct: Column, bins: int) -> Column:
    number = F.least(F.lit(bins), F.greatest(F.lit(2), distinct)).cast("int")
    # A single value stands in the middle of its bands.
    wider = lambda end, sign: F.when(low == high, end + sign * 0.001 * F.greatest(F.abs(end), F.lit(1.0))).otherwise(end)
    start, stop = wider(low, -1), wider(high, 1)
    return F.transform(F.sequence(F.lit(0), number), lambda i: start + (stop - start) * i / number)


def band(value: Column, edges: Column) -> Column:
    """Right-closed band number from 1, the lowest value included."""
    return F.greatest(F.lit(1), F.size(F.filter(edges, lambda e: e < value)))


def band_label(number: Column, edges: Column) -> Column:
    """A band's interval as text, open below and closed above; the lowest includes its start."""
    shown = lambda i: F.format_string("%.3f", F.element_at(edges, i))
    return F.concat(F.when(number == 1, "[").otherwise("("), shown(number), F.lit(", "), shown(number + 1), F.lit("]"))


def label_bands(table: DataFrame, edges: DataFrame) -> DataFrame:
    """A table of continuous bands with ``bin_label``, and bands numbered without gaps."""
    labelled = table.join(F.broadcast(edges), "feature").withColumn("bin_label", band_label(F.col("band"), F.col("edges"))).drop("edges")
    return labelled.withColumn("band", F.dense_rank().over(Window.partitionBy("feature").orderBy("band")))


def continuous_bands(df: DataFrame, features: list[str], target: str, bins: int = 10) -> DataFrame:
    long = long_form(df, features, target, "double")
    edges = quantile_edges(long, bins)  # a row a feature
    return long.join(F.broadcast(edges), "feature").select("feature", "target", band(F.col("value"), F.col("edges")).alias("band"))


def continuous_evidence(df: DataFrame, features: list[str], target: str, bins: int = 10) -> DataFrame:
    """``evidence`` of quantile bands; rows are read once, and counted by value."""
    counted = count_values(long_form(df, features, target, "double"))
    banded = counted.join(F.broadcast(counted_edges(counted, bins)), "feature")  # a row a feature
    return counted_evidence(banded.groupBy("feature", band(F.col("value"), F.col("edges")).alias("band")).agg(F.sum("good").alias("good_count"), F.sum("bad").alias("bad_count")))


def group_rare(long: DataFrame, min_share: float = 0.05) -> DataFrame:
    """Levels with less than ``min_share`` of their feature's rows become ``Other``."""
    levels = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    # What stays as it is are fewer than 1 / min_share levels a feature, so rows meet a small table, whatever their values.
    kept = levels.withColumn("all", F.sum("n").over(Window.partitionBy("feature"))).where(F.col("n") / F.col("all") >= min_share).select("feature", "value", F.lit(True).alias("kept"))
    return long.join(F.broadcast(kept), ["feature", "value"], "left").select("feature", "target", F.when(F.col("kept"), F.col("value")).otherwise(F.lit(OTHER)).alias("level"))


def categorical_evidence(long: DataFrame, min_share: float = 0.05) -> DataFrame:
    """``evidence`` of levels, rare ones grouped; rows are only counted, by feature and level."""
    levels = long.groupBy("feature", "value").agg(F.count("*").alias("n"), F.count_if(F.col("target") == 0).alias("good"), F.count_if(F.col("target") == 1).alias("bad"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("feature"))
    named = levels.withColumn("level", F.when(share < min_share, OTHER).otherwise(F.col("value")))
    return counted_evidence(named.groupBy("feature", "level").agg(F.sum("good").alias("good_count"), F.sum("bad").alias("bad_count")))


def evidence(groups: DataFrame, by: str) -> DataFrame:
    """Counts, smoothed distributions, WoE and IV per (feature, group); target 1 is bad."""
    return counted_evidence(groups.groupBy("feature", by).agg(F.count_if(F.col("target") == 0).alias("good_count"), F.count_if(F.col("target") == 1).alias("bad_count")))


def counted_evidence(counted: DataFrame) -> DataFrame:
    """``evidence`` of groups that are counted already; a feature has a few."""
    all_of = Window.partitionBy("feature")
    good = (F.col("good_count") + 0.5) / (F.sum("good_count").over(all_of) + 0.5)
    bad = (F.col("bad_count") + 0.5) / (F.sum("bad_count").over(all_of) + 0.5)
    return counted.withColumns({"good_dist": good, "bad_dist": bad}).withColumn("woe", F.ln(F.col("good_dist") / F.col("bad_dist"))).withColumn("iv", (F.col("good_dist") - F.col("bad_dist")) * F.col("woe"))


def number_bands(table: DataFrame, by: str) -> DataFrame:
    """Band numbers 1..n in order of ``by`` within each feature."""
    return table.withColumn("band", F.dense_rank().over(Window.partitionBy("feature").orderBy(by)))


def select_features(table: DataFrame) -> DataFrame:
    """(feature, iv, status) from a table of bands."""
    iv = F.round(F.sum("iv"), 4)
    status = F.when(F.sum("iv") < EXCLUDE_BELOW, "EXCLUDED").when(F.sum("iv") < WEAK_BELOW, "SELECTED_WEAK").otherwise("SELECTED")
    return table.groupBy("feature").agg(iv.alias("iv"), status.alias("status"))


def missing_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Status of features that can't be banded: not there, or null throughout."""
    there = [c for c in features if c in df.columns]
    row = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in there])
    items = [F.struct(F.lit(c).alias("feature"), (F.when(F.col(c) == 0, "ALL_NULL").otherwise("PRESENT") if c in there else F.lit("MISSING")).alias("status")) for c in features]
    return row.select(F.inline(F.array(*items)))


def feature_table(df: DataFrame, key: list[str], selection: DataFrame, target: str) -> DataFrame:
    """Keys, target and the features that the selection (a row a feature) keeps, for all populations."""
    kept = [r["feature"] for r in selection.where("status <> 'EXCLUDED'").select("feature").collect()]
    return df.select(*key, target, *sorted(c for c in kept if c in df.columns))


def transform(df: DataFrame, feature: str, edges: list[float], table: DataFrame, name: str) -> DataFrame:
    """Replace a continuous feature by its band's WoE: the table has a few rows a feature."""
    woe = table.where(F.col("feature") == feature).select("band", F.col("woe").alias(name))
    banded = df.withColumn("band", band(F.col(feature).cast("double"), F.array(*map(F.lit, edges))))
    return banded.join(F.broadcast(woe), "band", "left").drop("band")
