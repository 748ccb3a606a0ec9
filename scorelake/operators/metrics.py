"""Discrimination and drift metrics as distributed aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .ranges import ROWS_PER_RANGE, running_sums

PSI_WARNING, PSI_CRITICAL = 0.10, 0.25


def score_points(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Rows of label 1 (``_p``) and 0 (``_n``) per group and score ``_s``, written once: what every metric of these groups, or coarser ones, needs."""
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return written(rows.groupBy(*(by or []), F.col(score).cast("double").alias("_s")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")))


def point_metrics(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``roc_metrics`` from points of these groups or finer ones."""
    by, number = by or [], points.count()
    if set(points.columns) != {*by, "_s", "_p", "_n"}:
        points = points.groupBy(*by, "_s").agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
        points = points if number <= ROWS_PER_RANGE else written(points)
    running = running_sums(points, by, ["_s"], ["_p", "_n"], number)
    area = F.sum(F.col("_p") * (F.col("_upto__n") - F.col("_n") / 2)) / (F.first("_all__p") * F.first("_all__n"))
    gap = F.max(F.col("_upto__n") / F.nullif("_all__n", F.lit(0)) - F.col("_upto__p") / F.nullif("_all__p", F.lit(0)))
    both = (F.first("_all__p") > 0) & (F.first("_all__n") > 0)
    out = running.groupBy(*by).agg(F.sum(F.col("_p") + F.col("_n")).alias("n"), F.when(both, area).alias("_auc"), F.when(both, F.greatest(gap, F.lit(0.0))).alias("_ks"))
    return out.select(*by, "n", F.round("_auc", 4).alias("auc"), F.round(2 * F.col("_auc") - 1, 4).alias("gini"), F.round("_ks", 4).alias("ks"))


def roc_metrics(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """n, auc, gini and ks per group, 4 decimals; null where one class is missing.

    ``label`` is 1 for the class that high scores should find.  Rows are first summed per score;
    running counts are then built in two levels, so no task orders all scores.
    """
    return point_metrics(score_points(df, label, score, by), by)


def weighted_gini(df: DataFrame, label: str, score: str, by: str) -> DataFrame:
    """One row: the groups' ginis weighted by size; null keys and one-class groups don't count."""
    return mean_gini(roc_metrics(df.where(F.col(by).isNotNull()), label, score, [by]))


def mean_gini(groups: DataFrame) -> DataFrame:
    """One row from the metrics of groups: their ginis weighted by size, and the number of groups that have one."""
    groups = groups.where("gini is not null")
    return groups.agg(F.round(F.sum(F.col("n") * F.col("gini")) / F.sum("n"), 4).alias("weighted_gini"), F.count("*").alias("groups"))


def reconcile(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows compared, Pearson correlation, mean and largest absolute difference (all null without rows)."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    d = F.col(a) - F.col(b)
    return both.agg(F.count("*").alias("n"), F.round(F.corr(a, b), 4).alias("correlation"), F.round(F.avg(d), 4).alias("mean_diff"), F.round(F.max(F.abs(d)), 4).alias("max_abs_diff"))


def compare_models(challenger: DataFrame, champion: DataFrame | None) -> DataFrame:
    """Passed when the challenger's gini isn't lower, or there is no champion; other errors aren't hidden."""
    new = challenger.select(F.col("gini").alias("challenger_gini"))
    if champion is None:
        return new.select("challenger_gini", F.lit(None).cast("double").alias("champion_gini"), F.lit("passed").alias("comparison_result"))
    old = champion.select(F.col("gini").alias("champion_gini"))
    # Both are single rows.
    one = new.withColumn("_k", F.lit(1)).join(F.broadcast(old.withColumn("_k", F.lit(1))), "_k", "left").drop("_k")
    return one.withColumn("comparison_result", F.when(F.col("champion_gini").isNull() | (F.col("challenger_gini") >= F.col("champion_gini")), "passed").otherwise("failed"))


def psi(df: DataFrame, value: str, group: str, baseline: str, bins: int = 10) -> DataFrame:
    """(group, psi, alert) of every other group against the baseline.

    Bins have one width between the baseline's extremes, the last one closed; values outside drop.
    """
    rows = df.where(F.col(value).isNotNull())
    low, high = rows.where(F.col(group) == baseline).agg(F.min(value), F.max(value)).first()
    if low is None:
        return rows.select(F.col(group), F.lit(None).cast("double").alias("psi"), F.lit(None).cast("string").alias("alert_level")).limit(0)
    if low == high:
        low, high = low - 0.5, high + 0.5
    number = F.least(F.floor((F.col(value) - F.lit(low)) / F.lit((high - low) / bins)), F.lit(bins - 1)).cast("int")
    counts = rows.where(F.col(value).between(low, high)).groupBy(group, number.alias("bin")).agg(F.count("*").alias("n"))
    # Every group has all bins: groups times bins rows, then one pivoted row a group.
    wide = counts.groupBy(group).agg(*[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)).alias(f"b{i}") for i in range(bins)])
    shares = [(F.col(f"b{i}") + 0.5) / (sum(F.col(f"b{j}") for j in range(bins)) + 0.5) for i in range(bins)]
    wide = wide.select(group, F.array(*shares).alias("share"))
    expected = wide.where(F.col(group) == baseline).select(F.col("share").alias("expected"), F.lit(1).alias("_k"))
    both = wide.where(F.col(group) != baseline).withColumn("_k", F.lit(1)).join(F.broadcast(expected), "_k")
    total = F.aggregate(F.zip_with("share", "expected", lambda a, e: (a - e) * F.ln(a / e)), F.lit(0.0), lambda s, x: s + x)
    return both.select(group, F.round(total, 4).alias("psi")).withColumn("alert_level", alert(F.col("psi")))


def alert(value: Column) -> Column:
    return F.when(value >= PSI_CRITICAL, "critical").when(value >= PSI_WARNING, "warning").otherwise("none")


def metric_log(metrics: DataFrame, key: str, names: list[str], model: str, run: str) -> DataFrame:
    """Wide metrics as rows (model_name, run_timestamp, population, metric, value, alert_level), nulls left out."""
    items = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names]
    rows = metrics.select(F.col(key).alias("population"), F.inline(F.array(*items))).where("value is not null")
    return rows.select(F.lit(model).alias("model_name"), F.lit(run).alias("run_timestamp"), "population", "metric", "value", F.lit("none").alias("alert_level"))


#: The columns of an evaluation record.
EVALUATION = [
    "model_name string", "challenger_version long", "champion_version long", "evaluation_timestamp string", "eval_rows long", "auc double", "gini double", "ks double",
    "weighted_gini_by_dp3 double", "weighted_gini_by_pop double", "sas_correlation double", "sas_mean_diff double", "sas_max_abs_diff double", "champion_gini double", "comparison_result string",
]


def evaluation_record(overall: DataFrame, by_month: DataFrame, by_population: DataFrame, agreement: DataFrame, comparison: DataFrame, model: str, version: int, champion: int | None, run: str) -> DataFrame:
    """One row in the fixed schema EVALUATION from the one-row results of roc_metrics, weighted_gini (two), reconcile and compare_models."""
    parts = [
        overall.select(F.col("n").alias("eval_rows"), "auc", "gini", "ks"), by_month.select(F.col("weighted_gini").alias("weighted_gini_by_dp3")), by_population.select(F.col("weighted_gini").alias("weighted_gini_by_pop")),
        agreement.select(F.col("correlation").alias("sas_correlation"), F.col("mean_diff").alias("sas_mean_diff"), F.col("max_abs_diff").alias("sas_max_abs_diff")), comparison.select("champion_gini", "comparison_result"),
    ]
    row, *rest = [p.withColumn("_k", F.lit(1)) for p in parts]  # single rows
    for p in rest:
        row = row.join(F.broadcast(p), "_k")
    row = row.withColumns({"model_name": F.lit(model), "challenger_version": F.lit(version), "champion_version": F.lit(champion), "evaluation_timestamp": F.lit(run)})
    return row.select(*[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in EVALUATION])


def alert_rollup(log: DataFrame) -> DataFrame:
    """Alerts by level and the retraining decision."""
    critical = F.count_if(F.col("alert_level") == "critical")
    return log.agg(critical.alias("critical"), F.count_if(F.col("alert_level") == "warning").alias("warning"), (critical > 0).alias("retrain"))


def inference_profile(df: DataFrame, ts: str, predicted: str, label: str) -> DataFrame:
    """Per day: rows, rows without a label, confusion cells and accuracy of Bad/Good predictions."""
    cell = lambda p, o: F.count_if((F.col(predicted) == p) & (F.col(label) == o))
    right = F.count_if(F.col(predicted) == F.col(label))
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.col(label).isNull()).alias("unlabelled"), cell("Bad", "Bad").alias("bad_bad"), cell("Bad", "Good").alias("bad_good"),
        cell("Good", "Bad").alias("good_bad"), cell("Good", "Good").alias("good_good"), F.round(right / F.nullif(F.count(label), F.lit(0)), 4).alias("accuracy"),
    )
