"""Population split: out-of-time cut and a stable, stratified development sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = 16**7


def bucket(key: Column, seed: int) -> Column:
    """A number in [0, 16**7) that depends on key and seed alone, whatever the partitioning."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"))), 1, 7), 16, 10).cast("long")


def out_of_time_cut(df: DataFrame, date: str, months: int) -> Column:
    """First day of the out-of-time window: the largest date less ``months`` (one number to the driver)."""
    last = df.agg(F.max(date)).first()[0]
    return F.add_months(F.lit(last), -months)


def level_rate(level: str, rates: dict, default: float) -> Column:
    """The rate of a row's level; ``default`` for null and levels without one."""
    out = None
    for value, rate in rates.items():
        hit = F.col(level).eqNullSafe(F.lit(value))
        out = F.when(hit, F.lit(int(rate * SPAN))) if out is None else out.when(hit, F.lit(int(rate * SPAN)))
    return F.lit(int(default * SPAN)) if out is None else out.otherwise(F.lit(int(default * SPAN)))


def populations(df: DataFrame, key: str, date: str, funded: Column, cut: Column, dev_share: float = 0.7, seed: int = 42, level: str | None = None, rates: dict | None = None) -> DataFrame:
    """Label each row DEV, HOL, OOT, TTD (not funded) or NODATE (funded without a date).

    ``rates`` gives the development share of values of ``level``; ``dev_share`` is that of all others.
    """
    dev = bucket(F.col(key), seed) < (level_rate(level, rates or {}, dev_share) if level else F.lit(int(dev_share * SPAN)))
    label = (
        F.when(~F.coalesce(funded, F.lit(False)), "TTD").when(F.col(date).isNull(), "NODATE").when(F.col(date) >= cut, "OOT").when(dev, "DEV").otherwise("HOL")
    )
    return df.withColumn("_population", label)


def exact_quota(df: DataFrame, key: str, strata: list[str], share: float, seed: int = 42) -> DataFrame:
    """``_chosen``: exactly floor(share * n) rows of each stratum, in order of the bucket.

    Ranks come from counts per (stratum, slice of the bucket range), so a large stratum is ranked in parallel.
    """
    slices = min(max(256, df.count() // 500_000), 65_536)  # they grow in number with the rows
    rows = df.withColumn("_bucket", bucket(F.col(key), seed)).withColumn("_slice", F.floor(F.col("_bucket") * slices / SPAN).cast("int"))
    per_slice = rows.groupBy(*strata, "_slice").agg(F.count("*").alias("_n"))
    along = Window.partitionBy(*strata).orderBy("_slice")
    before = per_slice.select(
        *strata, "_slice", F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*strata)).alias("_total")
    )
    same = [rows[c].eqNullSafe(before[c]) for c in (*strata, "_slice")]
    ranked = rows.join(before, same).select(rows["*"], "_before", "_total")
    nth = F.row_number().over(Window.partitionBy(*strata, "_slice").orderBy("_bucket", key))
    return ranked.withColumn("_chosen", F.col("_before") + nth <= F.floor(F.col("_total") * share)).drop("_bucket", "_slice", "_before", "_total")


def sample_levels(df: DataFrame, key: str, level: str, rates: dict, default: float = 0.0, seed: int = 42) -> DataFrame:
    """Rows of each level at its rate, by the bucket of their key: the same rows whatever the partitioning, and no shuffle."""
    return df.where(bucket(F.col(key), seed) < level_rate(level, rates, default))


def sample_quota(df: DataFrame, key: str, level: str, quotas: dict, seed: int = 42, slices: int = 4096) -> DataFrame:
    """Exactly ``quotas[level]`` rows of each level (all, if it has fewer): those of the smallest buckets, ties by key.

    Rows are counted by level and slice of the bucket range.  The counts tell the slice in which a
    level's quota ends: rows of earlier slices are taken where they lie, and only those of that one
    slice are shuffled and ordered.  Keys should tell rows apart.
    """
    rows = df.withColumn("_bucket", bucket(F.col(key), seed)).withColumn("_slice", F.floor(F.col("_bucket") * slices / SPAN).cast("int"))
    wanted = df.sparkSession.createDataFrame([(v, int(n)) for v, n in quotas.items()], T.StructType([T.StructField("_level", df.schema[level].dataType), T.StructField("_quota", T.LongType())]))
    # Both tables are as large as ``quotas``, times the slices.
    counts = rows.join(F.broadcast(wanted), F.col(level).eqNullSafe(F.col("_level"))).groupBy("_level", "_quota", "_slice").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_level").orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = counts.withColumn("_upto", upto).groupBy("_level", "_quota").agg(
        F.min(F.when(F.col("_upto") > F.col("_quota"), F.col("_slice"))).alias("_end"), F.coalesce(F.max(F.when(F.col("_upto") <= F.col("_quota"), F.col("_upto"))), F.lit(0)).alias("_sure")
    )
    dealt = rows.join(F.broadcast(ends), F.col(level).eqNullSafe(F.col("_level")))
    sure = dealt.where("_end is null or _slice < _end").select(*df.columns)
    nth = F.row_number().over(Window.partitionBy("_level").orderBy("_bucket", key))
    rest = dealt.where("_slice = _end").withColumn("_nth", nth).where("_nth <= _quota - _sure").select(*df.columns)
    return sure.unionByName(rest)
