"""The reporting queries over scores, metric logs and layer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import reports
from ..sources import sinks
from ..sources.tables import load
from . import query
from .analytics import LABELLED_SQL, PSI_SQL, SCORED_SQL, evaluations, metric_log, scored
from .folders import shared_folder, written
from .history import LOG_SQL, version_log

LOG_METRICS = """,
x as (select _population as grp, p_bad as score, (_observed_label = 'Bad')::int as bad from scored where _observed_label is not null),
s as (select grp, score, sum(bad) as p, count(*) - sum(bad) as q from x group by all),
c as (select *, sum(q) over (partition by grp order by score) as qc, sum(p) over (partition by grp order by score) as pc, sum(p) over (partition by grp) as pt, sum(q) over (partition by grp) as qt from s),
roc as (select grp, sum(p * (qc - q / 2)) / (max(pt) * max(qt)) as auc, greatest(max(qc / qt - pc / pt), 0.0) as ks from c group by grp),
m as (select grp as population, 'auc' as metric, round(auc, 4) as value from roc union all select grp, 'gini', round(2 * auc - 1, 4) from roc union all select grp, 'ks', round(ks, 4) from roc)
"""


@query(PSI_SQL + "select 2::bigint as latest_model_version, (select count(*) from orders) as total_scored, '2024-02-01 00:00:00' as last_run, count(*) filter (alert_level = 'critical') as critical_alerts, count(*) filter (alert_level = 'warning') as warning_alerts from drift")
def report_headline(spark, sf_dir):
    rows = written(scored(spark, sf_dir))
    return reports.headline(rows, written(metric_log(spark, sf_dir, rows)), evaluations(spark, sf_dir))


WEIGHTED_SQL = """,
wx as (select last_day(application_date) as grp, p_bad as score, (_observed_label = 'Bad')::int as bad from scored where _observed_label is not null),
ws as (select grp, score, sum(bad) as p, count(*) - sum(bad) as q from wx group by all),
wc as (select *, sum(q) over (partition by grp order by score) as qc, sum(p) over (partition by grp) as pt, sum(q) over (partition by grp) as qt from ws),
wg as (select grp, sum(p + q) as n, case when max(pt) > 0 and max(qt) > 0 then round(2 * (sum(p * (qc - q / 2)) / (max(pt) * max(qt))) - 1, 4) end as gini from wc group by grp),
wall as (select round(sum(n * gini) / sum(n), 4) as value from wg where gini is not null)
"""


@query(PSI_SQL.rstrip() + LOG_METRICS + WEIGHTED_SQL + """,
lg as (select population, metric, value, 'none' as alert_level from m where value is not null union all select 'ALL', 'weighted_gini_dp3', value, 'none' from wall union all select _population, 'psi_p_good', psi, alert_level from drift)
select 'log' as source, run_timestamp, population, metric, value, alert_level from lg, (values ('2024-02-01 00:00:00'), ('2024-03-01 00:00:00')) r(run_timestamp)
union all select 'baseline', '2024-02-01 00:00:00', population, metric, value, alert_level from lg""")
def monitoring_log(spark, sf_dir):
    """Two monitoring runs appended to one log; the baseline is the first run's and stays."""
    folder = shared_folder(spark)
    first = written(metric_log(spark, sf_dir))
    for run in (first, first.withColumn("run_timestamp", F.lit("2024-03-01 00:00:00"))):
        sinks.append(run, f"{folder}/log")
        sinks.write_once(run, f"{folder}/baseline")
    read = lambda name: sinks.read_merged(spark, f"{folder}/{name}").select(F.lit(name).alias("source"), "run_timestamp", "population", "metric", "value", "alert_level")
    return read("log").unionByName(read("baseline"))


@query(SCORED_SQL + LOG_METRICS + "select population, metric, value from m")
def report_performance(spark, sf_dir):
    return reports.performance(metric_log(spark, sf_dir))


@query(PSI_SQL + "select _population as population, psi, alert_level from drift")
def report_drift(spark, sf_dir):
    return reports.drift(metric_log(spark, sf_dir))


@query(SCORED_SQL + "select risk_grade, count(*) as n, round(avg(final_p_good), 4) as avg_p_good from scored group by 1")
def report_grades(spark, sf_dir):
    return reports.grade_distribution(scored(spark, sf_dir))


@query(SCORED_SQL + "select goodbadflag_inferred as predicted, coalesce(_observed_label, 'NULL (no ground truth)') as observed, count(*) as n from scored group by all")
def report_confusion(spark, sf_dir):
    return reports.confusion(scored(spark, sf_dir))


@query(SCORED_SQL + "select cast(floor(credit_score / 50) * 50 as bigint) as score_bucket, sample_flag, count(*) as n from scored group by all")
def report_score_histogram(spark, sf_dir):
    return reports.score_histogram(scored(spark, sf_dir))


@query(SCORED_SQL + "select round(avg(credit_score), 4) as mean_score, cast(quantile_cont(credit_score, 0.5) as double) as median_score, min(credit_score) as min_score, max(credit_score) as max_score from scored")
def report_score_summary(spark, sf_dir):
    return reports.score_summary(scored(spark, sf_dir))


def _auc_sql(version: int, score: str) -> str:
    return f"""select {version}::bigint as challenger_version, sum(p + q)::bigint as eval_rows, sum(p * (qc - q / 2)) / (max(pt) * max(qt)) as auc, greatest(max(qc / qt - pc / pt), 0.0) as ks from (
  select *, sum(q) over (order by score) as qc, sum(p) over (order by score) as pc, sum(p) over () as pt, sum(q) over () as qt from (
    select {score} as score, sum(bad) as p, count(*) - sum(bad) as q from x where {score} is not null group by 1))"""


@query(LABELLED_SQL + f"r as ({_auc_sql(1, 'c_acctbal')} union all {_auc_sql(2, 'o_totalprice')}) select challenger_version, eval_rows, round(auc, 4) as auc, round(2 * auc - 1, 4) as gini, round(ks, 4) as ks from r")
def report_evaluations(spark, sf_dir):
    return reports.evaluation_history(evaluations(spark, sf_dir))


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by all")
def report_distribution(spark, sf_dir):
    return reports.distribution(load(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query(" union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in ("customer", "orders", "lineitem", "events", "documents")))
def report_row_counts(spark, sf_dir):
    return reports.row_counts({t: load(spark, sf_dir, t) for t in ("customer", "orders", "lineitem", "events", "documents")})


@query(LOG_SQL + "select 'user_state' as table_name, count(*) filter (_is_current) as current_rows, count(*) as total_rows from log")
def report_version_counts(spark, sf_dir):
    return reports.version_counts({"user_state": version_log(spark, sf_dir)})


@query("select o_orderpriority, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 2) as pct from orders group by 1")
def report_share(spark, sf_dir):
    return reports.share_of_total(load(spark, sf_dir, "orders"), "o_orderpriority")


@query("select l_suppkey, count(*) as n from lineitem group by 1 order by n desc, l_suppkey limit 5")
def report_top_levels(spark, sf_dir):
    return reports.top_levels(load(spark, sf_dir, "lineitem"), "l_suppkey")


@query("select count(*) as n, count(distinct o_custkey) as n_keys, min(o_orderdate) as low, max(o_orderdate) as high from orders")
def report_shape(spark, sf_dir):
    return reports.shape(load(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query("select c_mktsegment, round(min(o_totalprice), 2) as low, round(avg(o_totalprice), 2) as mean, round(max(o_totalprice), 2) as high, count(*) filter (o_orderstatus = 'F') as bad from orders join customer on o_custkey = c_custkey group by 1")
def report_amounts(spark, sf_dir):
    joined = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.round(F.min("o_totalprice"), 2).alias("low"), F.round(F.avg("o_totalprice"), 2).alias("mean"), F.round(F.max("o_totalprice"), 2).alias("high"), F.count_if(F.col("o_orderstatus") == "F").alias("bad")
    )
