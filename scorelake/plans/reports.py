"""Reporting queries over scores, metric logs and layer tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# This text and the column names of the reports.
UNKNOWN = "NULL (no ground truth)"


def latest_run(log: DataFrame, run: str = "run_timestamp") -> DataFrame:
    """Rows of the last run, by a one-row join."""
    last = log.agg(F.max(run).alias(run))
    return log.join(F.broadcast(last), run, "left_semi")


def headline(scored: DataFrame, log: DataFrame, evaluations: DataFrame) -> DataFrame:
    """One row: latest model version, rows scored, last run and its alerts."""
    alerts = latest_run(log).agg(F.max("run_timestamp").alias("last_run"), F.count_if(F.col("alert_level") == "critical").alias("critical_alerts"), F.count_if(F.col("alert_level") == "warning").alias("warning_alerts"))
    parts = [evaluations.agg(F.max("challenger_version").alias("latest_model_version")), scored.agg(F.count("*").alias("total_scored")), alerts]
    parts = [p.withColumn("_k", F.lit(1)) for p in parts]  # single rows
    return reduce(lambda a, b: a.join(F.broadcast(b), "_k"), parts).drop("_k")


def performance(log: DataFrame) -> DataFrame:
    return latest_run(log).where(F.col("metric").isin("gini", "auc", "ks")).select("population", "metric", "value").orderBy("metric", "population")


def drift(log: DataFrame) -> DataFrame:
    return latest_run(log).where("metric = 'psi_p_good'").select("population", F.round("value", 4).alias("psi"), "alert_level")


def grade_distribution(scored: DataFrame) -> DataFrame:
    return scored.groupBy("risk_grade").agg(F.count("*").alias("n"), F.round(F.avg("final_p_good"), 4).alias("avg_p_good")).orderBy("risk_grade")


def confusion(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy(F.col("goodbadflag_inferred").alias("predicted"), F.coalesce("_observed_label", F.lit(UNKNOWN)).alias("observed"))
        .agg(F.count("*").alias("n")).orderBy("observed", "predicted")
    )


def score_histogram(scored: DataFrame, width: int = 50) -> DataFrame:
    bucket = (F.floor(F.col("credit_score") / width) * width).cast("long")
    return scored.groupBy(bucket.alias("score_bucket"), "sample_flag").agg(F.count("*").alias("n")).orderBy("score_bucket")


def score_summary(scored: DataFrame) -> DataFrame:
    s = F.col("credit_score")
    return scored.agg(F.round(F.avg(s), 4).alias("mean_score"), F.percentile(s, F.lit(0.5)).alias("median_score"), F.min(s).alias("min_score"), F.max(s).alias("max_score"))


def evaluation_history(evaluations: DataFrame) -> DataFrame:
    return evaluations.orderBy(F.desc("challenger_version"))


def distribution(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(*keys)


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Counts with their percentage of all rows: the window runs over the grouped rows only."""
    counted = df.groupBy(key).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0))), 2))


def top_levels(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()])


def version_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [t.agg(F.count_if("_is_current").alias("current_rows"), F.count("*").alias("total_rows")).select(F.lit(n).alias("table_name"), "current_rows", "total_rows") for n, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def shape(df: DataFrame, key: str, low: str) -> DataFrame:
    """Rows, distinct keys, and the range of a column."""
    return df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("n_keys"), F.min(low).alias("low"), F.max(low).alias("high"))
