"""WoE and selection, discrimination, drift, scoring and models over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scorecard
from ..operators import metrics, model, standardize, woe
from ..operators import sketches as sketch
from ..sources.tables import load
from . import query
from .folders import shared_folder, written
from .gold import POPULATION_SQL, populated

CONTINUOUS = ["o_totalprice", "c_acctbal"]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funded orders with the binary target: status F is bad, O is good."""
    orders = load(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    customer = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    return orders.join(customer, "o_custkey", "left").withColumn("bad", (F.col("o_orderstatus") == "F").cast("int"))


LABELLED_SQL = """
with x as (select o_orderkey, o_totalprice, c_acctbal, c_mktsegment, o_orderpriority, o_orderdate, (o_orderstatus = 'F')::int as bad
           from orders left join customer on o_custkey = c_custkey where o_orderstatus in ('F', 'O')),
"""
CONTINUOUS_SQL = LABELLED_SQL + """
long as (select 'o_totalprice' as feature, o_totalprice as v, bad from x union all select 'c_acctbal', c_acctbal, bad from x where c_acctbal is not null),
edges as (select feature, list_sort(list_distinct(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) as e from long group by 1),
banded as (select l.feature, bad, greatest(1, len(list_filter(e, lambda q: q < v)))::int as band from long l join edges on l.feature = edges.feature),
"""
CATEGORICAL_SQL = """
clong as (select 'c_mktsegment' as feature, c_mktsegment as v, bad from x union all select 'o_orderpriority', o_orderpriority, bad from x
          union all select 'discount', cast(cast(l_discount as decimal(4,2)) as varchar), (o_orderstatus = 'F')::int from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus in ('F', 'O')),
lv as (select feature, v, case when count(*) / sum(count(*)) over (partition by feature) < 0.05 then 'Other' else v end as level from clong where v is not null group by 1, 2),
cb as (select c.feature, bad, level from clong c join lv on c.feature = lv.feature and c.v = lv.v),
"""
COLUMNS = "good_count, bad_count, round(good_dist, 6) as good_dist, round(bad_dist, 6) as bad_dist, round(woe, 6) as woe, round(iv, 6) as iv"


def evidence_sql(name: str, source: str, by: str) -> str:
    return f"""
{name}_c as (select feature, {by}, count(*) filter (bad = 0) as good_count, count(*) filter (bad = 1) as bad_count from {source} group by all),
{name}_d as (select *, (good_count + 0.5) / (sum(good_count) over (partition by feature) + 0.5) as good_dist, (bad_count + 0.5) / (sum(bad_count) over (partition by feature) + 0.5) as bad_dist from {name}_c),
{name} as (select *, ln(good_dist / bad_dist) as woe, (good_dist - bad_dist) * ln(good_dist / bad_dist) as iv from {name}_d)"""


def rounded(table: DataFrame, *first: str) -> DataFrame:
    return table.select(*first, "good_count", "bad_count", *[F.round(c, 6).alias(c) for c in ("good_dist", "bad_dist", "woe", "iv")])


def continuous_table(spark, sf_dir) -> DataFrame:
    return woe.continuous_evidence(labelled(spark, sf_dir), CONTINUOUS, "bad")


def categorical_table(spark, sf_dir) -> DataFrame:
    orders = labelled(spark, sf_dir)
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount"))
    long = woe.long_form(orders, ["c_mktsegment", "o_orderpriority"], "bad", "string").unionByName(woe.long_form(lines.join(orders.select("o_orderkey", "bad"), "o_orderkey"), ["discount"], "bad", "string"))
    return woe.number_bands(woe.categorical_evidence(long), "level")


@query(CONTINUOUS_SQL + evidence_sql("w", "banded", "band") + f"select feature, band, {COLUMNS} from w")
def woe_continuous(spark, sf_dir):
    return rounded(continuous_table(spark, sf_dir), "feature", "band")


@query(CONTINUOUS_SQL + evidence_sql("w", "banded", "band") + """
select w.feature, cast(dense_rank() over (partition by w.feature order by band) as int) as band, w.good_count, w.bad_count,
  case band when 1 then '[' else '(' end || printf('%.3f', e[band]) || ', ' || printf('%.3f', e[band + 1]) || ']' as bin_label from w join edges on edges.feature = w.feature""")
def woe_labels(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    edges = woe.quantile_edges(woe.long_form(rows, CONTINUOUS, "bad", "double"))
    return woe.label_bands(continuous_table(spark, sf_dir), edges).select("feature", "band", "good_count", "bad_count", "bin_label")


@query(LABELLED_SQL + CATEGORICAL_SQL + evidence_sql("w", "cb", "level") + f"select feature, level, cast(dense_rank() over (partition by feature order by level) as int) as band, {COLUMNS} from w")
def woe_categorical(spark, sf_dir):
    return rounded(categorical_table(spark, sf_dir), "feature", "level", "band")


@query(CONTINUOUS_SQL + CATEGORICAL_SQL.lstrip() + evidence_sql("w", "banded", "band") + "," + evidence_sql("k", "cb", "level") + """
select feature, round(sum(iv), 4) as iv, case when sum(iv) < 0.02 then 'EXCLUDED' when sum(iv) < 0.10 then 'SELECTED_WEAK' else 'SELECTED' end as status
from (select feature, iv from w union all select feature, iv from k) group by 1""")
def iv_select(spark, sf_dir):
    both = continuous_table(spark, sf_dir).select("feature", "iv").unionByName(categorical_table(spark, sf_dir).select("feature", "iv"))
    return woe.select_features(both)


@query(CONTINUOUS_SQL + evidence_sql("w", "banded", "band") + """
select o_orderkey, round(woe, 6) as woe from x join edges on edges.feature = 'o_totalprice'
join w on w.feature = 'o_totalprice' and w.band = greatest(1, len(list_filter(e, lambda q: q < o_totalprice)))""")
def woe_transform(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    long = woe.long_form(rows, ["o_totalprice"], "bad", "double")
    edges = woe.quantile_edges(long).first()["edges"]
    table = woe.continuous_evidence(rows, ["o_totalprice"], "bad")
    return woe.transform(rows, "o_totalprice", edges, table, "woe").select("o_orderkey", F.round("woe", 6).alias("woe"))


@query(LABELLED_SQL + "f as (select 1) select 'o_totalprice' as feature, case when (select count(o_totalprice) from x) = 0 then 'ALL_NULL' else 'PRESENT' end as status union all select 'no_such', 'MISSING'")
def feature_presence(spark, sf_dir):
    return woe.missing_features(labelled(spark, sf_dir), ["o_totalprice", "no_such"])


@query("""
with l as (select l_quantity as v, l_returnflag from lineitem), m as (select min(v) as lo, max(v) as hi, least(10, greatest(2, count(distinct v))) as k from l),
e as (select list_transform(generate_series(0, k), lambda i: lo + (hi - lo) * i / k) as edges from m)
select greatest(1, len(list_filter(edges, lambda q: q < v)))::int as band, count(*) as n from l, e group by 1""")
def equal_width_bands(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").withColumn("bad", (F.col("l_returnflag") == "R").cast("int"))
    long = woe.long_form(rows, ["l_quantity"], "bad", "double")
    banded = long.join(F.broadcast(woe.equal_width_edges(long)), "feature").select(woe.band(F.col("value"), F.col("edges")).alias("band"))
    return banded.groupBy("band").agg(F.count("*").alias("n"))


ROC_SQL = """
, s as (select {by} as grp, {score} as score, sum(bad) as p, count(*) - sum(bad) as q from x group by all),
c as (select *, sum(q) over (partition by grp order by score) as qc, sum(p) over (partition by grp order by score) as pc, sum(p) over (partition by grp) as pt, sum(q) over (partition by grp) as qt from s),
roc as (select grp, sum(p + q)::bigint as n, round(case when max(pt) > 0 and max(qt) > 0 then sum(p * (qc - q / 2)) / (max(pt) * max(qt)) end, 4) as auc,
  round(case when max(pt) > 0 and max(qt) > 0 then 2 * (sum(p * (qc - q / 2)) / (max(pt) * max(qt))) - 1 end, 4) as gini,
  round(case when max(pt) > 0 and max(qt) > 0 then greatest(max(qc / nullif(qt, 0) - pc / nullif(pt, 0)), 0.0) end, 4) as ks from c group by grp)
"""
X_SQL = LABELLED_SQL.rstrip().rstrip(",")
SCORE = "round(o_totalprice / 1000)"


def scored_orders(spark, sf_dir) -> DataFrame:
    return labelled(spark, sf_dir).withColumn("score", F.round(F.col("o_totalprice") / 1000)).withColumn("month", F.last_day(F.to_date("o_orderdate")))


@query(X_SQL + ROC_SQL.format(by="c_mktsegment", score=SCORE) + "select grp as c_mktsegment, n, auc, gini, ks from roc")
def auc_gini_ks(spark, sf_dir):
    return metrics.roc_metrics(scored_orders(spark, sf_dir), "bad", "score", ["c_mktsegment"])


@query(X_SQL + ROC_SQL.format(by="1", score="o_totalprice") + "select n, auc, gini, ks from roc")
def auc_gini_ks_overall(spark, sf_dir):
    return metrics.roc_metrics(labelled(spark, sf_dir), "bad", "o_totalprice")


@query(X_SQL + ROC_SQL.format(by="last_day(cast(o_orderdate as date))", score=SCORE) + "select round(sum(n * gini) / sum(n), 4) as weighted_gini, count(*) as groups from roc where gini is not null")
def weighted_gini(spark, sf_dir):
    return metrics.weighted_gini(scored_orders(spark, sf_dir), "bad", "score", "month")


OFFERED = ["o_totalprice", "c_acctbal", "order_age"]
FEATURES_SQL = POPULATION_SQL + """,
a as (select application_id, _population, case when o_orderstatus <> 'P' then (o_totalprice >= 300000)::int end as bad, o_totalprice, c_acctbal, cast(date '1999-01-01' - application_date as double) as order_age
      from pop left join customer on c_custkey = o_custkey),
long as (select 'o_totalprice' as feature, o_totalprice as v, bad from a where _population = 'DEV' and bad is not null union all select 'c_acctbal', c_acctbal, bad from a where _population = 'DEV' and bad is not null and c_acctbal is not null
         union all select 'order_age', order_age, bad from a where _population = 'DEV' and bad is not null),
edges as (select feature, list_sort(list_distinct(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) as e from long group by 1),
banded as (select l.feature, bad, greatest(1, len(list_filter(e, lambda q: q < v)))::int as band from long l join edges on l.feature = edges.feature),
"""


@query(FEATURES_SQL + evidence_sql("w", "banded", "band") + """,
kept as (select feature from w group by 1 having sum(iv) >= 0.02)
select application_id, _population, bad, feature, round(value, 4) as value from (
  select application_id, _population, bad, 'o_totalprice' as feature, o_totalprice as value from a union all select application_id, _population, bad, 'c_acctbal', c_acctbal from a
  union all select application_id, _population, bad, 'order_age', order_age from a) where feature in (select feature from kept)""")
def feature_table(spark, sf_dir):
    """The feature table of all populations, a row a value: only features that their IV on DEV selects."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    # A stand-in target that the amount tells and the other features don't; rejected applications have none.
    target = F.when(F.col("o_orderstatus") != "P", (F.col("o_totalprice") >= 300000).cast("int"))
    rows = populated(spark, sf_dir).withColumnRenamed("amount", "o_totalprice").join(customer, "c_custkey", "left")
    rows = rows.withColumns({"bad": target, "order_age": F.date_diff(F.lit("1999-01-01").cast("date"), "application_date").cast("double")})
    dev = rows.where("_population = 'DEV' and bad is not null")
    table = woe.feature_table(rows, ["application_id", "_population"], woe.select_features(woe.continuous_evidence(dev, OFFERED, "bad")), "bad")
    kept = [c for c in table.columns if c in OFFERED]
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.col(c).cast("double"), 4).alias("value")) for c in kept]) if kept else F.expr("cast(array() as array<struct<feature:string,value:double>>)")
    return table.select("application_id", "_population", "bad", F.inline(values))


@query()
def feature_table_populations(spark, sf_dir):
    """Every application with the features that their IV on DEV selects; the target of rejected ones is null."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    target = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    rows = populated(spark, sf_dir).withColumnsRenamed({"amount": "o_totalprice", "priority": "o_orderpriority"}).join(customer, "c_custkey", "left").withColumn("bad", target)
    dev = rows.where("_population = 'DEV' and bad is not null")
    continuous = woe.continuous_evidence(dev, CONTINUOUS, "bad").select("feature", "iv")
    categorical = woe.categorical_evidence(woe.long_form(dev, ["c_mktsegment", "o_orderpriority"], "bad", "string")).select("feature", "iv")
    return woe.feature_table(rows, ["application_id", "_population"], woe.select_features(continuous.unionByName(categorical)), "bad")


@query(X_SQL + ", d as (select o_totalprice / 1e6 as a, o_totalprice / 1e6 + c_acctbal / 1e5 as b from x) select count(*) as n, round(corr(a, b), 4) as correlation, round(avg(a - b), 4) as mean_diff, round(max(abs(a - b)), 4) as max_abs_diff from d where a is not null and b is not null")
def score_reconcile(spark, sf_dir):
    a = F.col("o_totalprice") / 1e6
    return metrics.reconcile(labelled(spark, sf_dir).withColumns({"a": a, "b": a + F.col("c_acctbal") / 1e5}), "a", "b")


@query(X_SQL + ROC_SQL.format(by="1", score="o_totalprice") + ", " + """
s2 as (select c_acctbal as score, sum(bad) as p, count(*) - sum(bad) as q from x where c_acctbal is not null group by 1),
c2 as (select *, sum(q) over (order by score) as qc, sum(p) over () as pt, sum(q) over () as qt from s2),
g2 as (select round(2 * (sum(p * (qc - q / 2)) / (max(pt) * max(qt))) - 1, 4) as gini from c2)
select roc.gini as challenger_gini, g2.gini as champion_gini, case when roc.gini >= g2.gini then 'passed' else 'failed' end as comparison_result from roc, g2""")
def champion_compare(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return metrics.compare_models(metrics.roc_metrics(rows, "bad", "o_totalprice"), metrics.roc_metrics(rows, "bad", "c_acctbal"))


def p_bad():
    """A stand-in probability from the order's amount."""
    return 1 / (1 + F.exp(F.lit(6.0) - F.col("amount") / 100000.0))


P_BAD = "1 / (1 + exp(6.0 - o_totalprice / 100000.0))"
SCORED_SQL = POPULATION_SQL + f""",
p as (select *, {P_BAD} as p_bad from pop),
q as (select *, cast(least(greatest(round_even(600 - 20 / ln(2) * ln(50) + 20 / ln(2) * ln((1 - p_bad) / greatest(p_bad, 1e-10)), 0), 0), 999) as int) as credit_score from p),
scored as (select *, 1 - p_bad as final_p_good, case when 1 - p_bad >= 0.95 then 'Good' else 'Bad' end as goodbadflag_inferred,
  case when credit_score >= 750 then 'A1' when credit_score >= 700 then 'A2' when credit_score >= 650 then 'B1' when credit_score >= 600 then 'B2'
       when credit_score >= 550 then 'C1' when credit_score >= 500 then 'C2' else 'D' end as risk_grade,
  case when o_orderstatus = 'P' then 'NotFunded' else 'Funded' end as sample_flag,
  case o_orderstatus when 'F' then 'Bad' when 'O' then 'Good' end as _observed_label from q)
"""


def scored(spark, sf_dir) -> DataFrame:
    rows = populated(spark, sf_dir).withColumn("p_bad", p_bad())
    rows = scorecard.score_columns(rows, "p_bad").withColumn("sample_flag", F.when(F.col("o_orderstatus") == "P", "NotFunded").otherwise("Funded"))
    target = F.when(F.col("o_orderstatus") == "F", "Bad").when(F.col("o_orderstatus") == "O", "Good").otherwise("Rejected")
    return rows.withColumn("_observed_label", scorecard.observed_label(F.col("sample_flag"), target))


@query(SCORED_SQL + "select application_id, credit_score, risk_grade, goodbadflag_inferred, round(final_p_good, 6) as final_p_good, _observed_label from scored")
def scorecard_points(spark, sf_dir):
    return scored(spark, sf_dir).select("application_id", "credit_score", "risk_grade", "goodbadflag_inferred", F.round("final_p_good", 6).alias("final_p_good"), "_observed_label")


@query(SCORED_SQL + "select application_id, risk_grade, timestamp '2024-02-01 00:00:00' as _scored_at, 'scorecard' as _model_name, 'models:/scorecard/2' as _model_uri, 2 as _model_version from scored")
def score_lineage(spark, sf_dir):
    rows = scorecard.lineage(scored(spark, sf_dir), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), "scorecard", "models:/scorecard/2", 2)
    return standardize.keep_existing(rows, ["application_id", "risk_grade", "no_such_column", "_scored_at", "_model_name", "_model_uri", "_model_version"])


PSI_SQL = SCORED_SQL + """,
b as (select min(final_p_good) as lo, max(final_p_good) as hi from scored where _population = 'DEV'),
h as (select _population, least(floor((final_p_good - lo) / ((hi - lo) / 10)), 9) as bin, count(*) as n from scored, b where final_p_good between lo and hi group by all),
g as (select p._population, i as bin, coalesce(n, 0) as n from (select distinct _population from scored) p cross join range(10) r(i) left join h on h._population = p._population and h.bin = i),
sh as (select _population, bin, (n + 0.5) / (sum(n) over (partition by _population) + 0.5) as s from g),
psi as (select a._population, round(sum((a.s - e.s) * ln(a.s / e.s)), 4) as psi from sh a join sh e on a.bin = e.bin and e._population = 'DEV' where a._population <> 'DEV' group by 1),
drift as (select *, case when psi >= 0.25 then 'critical' when psi >= 0.10 then 'warning' else 'none' end as alert_level from psi)
"""


def drift(spark, sf_dir) -> DataFrame:
    return metrics.psi(scored(spark, sf_dir), "final_p_good", "_population", "DEV")


@query(PSI_SQL + "select _population, psi, alert_level from drift")
def psi_drift(spark, sf_dir):
    return drift(spark, sf_dir)


@query(PSI_SQL + "select count(*) filter (alert_level = 'critical') as critical, count(*) filter (alert_level = 'warning') as warning, count(*) filter (alert_level = 'critical') > 0 as retrain from drift")
def alert_rollup(spark, sf_dir):
    return metrics.alert_rollup(drift(spark, sf_dir))


@query("""
with e as (select cast(ts as date) as day, case when value >= 30 then 'Bad' else 'Good' end as pred, case event_type when 'error' then 'Bad' when 'purchase' then 'Good' when 'click' then 'Good' end as lab from events)
select day, count(*) as n, count(*) filter (lab is null) as unlabelled, count(*) filter (pred = 'Bad' and lab = 'Bad') as bad_bad, count(*) filter (pred = 'Bad' and lab = 'Good') as bad_good,
  count(*) filter (pred = 'Good' and lab = 'Bad') as good_bad, count(*) filter (pred = 'Good' and lab = 'Good') as good_good, round(count(*) filter (pred = lab) / nullif(count(lab), 0), 4) as accuracy from e group by 1""")
def inference_profile(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select(
        "ts", F.when(F.col("value") >= 30, "Bad").otherwise("Good").alias("pred"), F.when(F.col("event_type") == "error", "Bad").when(F.col("event_type").isin("purchase", "click"), "Good").alias("lab")
    )
    return metrics.inference_profile(rows, "ts", "pred", "lab")


NUMERIC, CATEGORIES = ["o_totalprice", "c_acctbal"], ["c_mktsegment"]


def _training(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = populated(spark, sf_dir).select(F.col("application_id").alias("o_orderkey"), "_population")
    customer = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    orders = load(spark, sf_dir, "orders").join(customer, "o_custkey", "left").join(rows, "o_orderkey").withColumn("bad", (F.col("o_orderstatus") == "F").cast("int"))
    columns = ["o_orderkey", "_population", "bad", *NUMERIC, *CATEGORIES]
    # Fitting passes over the rows many times: the joins are done once.
    funded = written(model.prepare(orders.where("o_orderstatus <> 'P'").select(*columns), NUMERIC, CATEGORIES))
    return funded, model.prepare(orders.where("o_orderstatus = 'P'").select(*columns), NUMERIC, CATEGORIES, fill=True)


NEWTON_STEPS = 8
TRAINING_SQL = POPULATION_SQL + """,
t as (select application_id as o_orderkey, _population, (o_orderstatus = 'F')::int::double as bad, o_orderstatus = 'P' as rejected, o_totalprice::double as a, c_acctbal as b, c_mktsegment as s from pop left join customer on o_custkey = c_custkey),
d as (select * from t where rejected or (a is not null and b is not null and s is not null)),
lev as (select s, row_number() over (order by s) - 1 as code from (select distinct s from d where _population = 'DEV')),
raw as (select o_orderkey, _population, bad, rejected, coalesce(a, 0) as a, coalesce(b, 0) as b, coalesce(code, (select count(*) from lev))::double as c from d left join lev on d.s = lev.s),
m as (select avg(a) as ma, stddev_samp(a) as sa, avg(b) as mb, stddev_samp(b) as sb, avg(c) as mc, stddev_samp(c) as sc from raw where _population = 'DEV'),
z as materialized (select o_orderkey, _population, bad, rejected, (a - ma) / sa as x1, (b - mb) / sb as x2, (c - mc) / sc as x3 from raw, m),
"""
# Indices of the information matrix's upper triangle.
TRIANGLE = [(i, j) for i in range(4) for j in range(i, 4)]
MARGIN_SQL = "b0 + b1 * x1 + b2 * x2 + b3 * x3"


def _information_sql(extra: str = "") -> str:
    names = ["1", "x1", "x2", "x3"]
    return ", ".join(f"sum(v * {names[i]} * {names[j]}){f' + {extra}' if extra and i == j and i else ''} as h{i}{j}" for i, j in TRIANGLE)


# Factors of the matrix h = l l', one after the other.
CHOLESKY_SQL = """sqrt(h00) as l00, h01 / l00 as l10, h02 / l00 as l20, h03 / l00 as l30, sqrt(h11 - l10 * l10) as l11, (h12 - l20 * l10) / l11 as l21, (h13 - l30 * l10) / l11 as l31,
  sqrt(h22 - l20 * l20 - l21 * l21) as l22, (h23 - l30 * l20 - l31 * l21) / l22 as l32, sqrt(h33 - l30 * l30 - l31 * l31 - l32 * l32) as l33"""


def _newton_sql(name: str, rows: str) -> str:
    """CTEs that end in ``name`` (b0 to b3): Newton steps over ``rows`` (x1 to x3, y, w), each solved by Cholesky factors."""
    parts = [f"{name}0 as (select 0::double as b0, 0::double as b1, 0::double as b2, 0::double as b3)"]
    for i in range(NEWTON_STEPS):
        here = f"{name}{i}"
        parts.append(f"{here}p as (select r.*, 1 / (1 + exp(-({MARGIN_SQL}))) as p from {rows} r, {here})")
        parts.append(f"{here}v as (select *, w * p * (1 - p) as v, w * (y - p) as q from {here}p)")
        parts.append(f"{here}s as (select sum(q) as g0, sum(q * x1) as e1, sum(q * x2) as e2, sum(q * x3) as e3, {_information_sql('1')} from {here}v)")
        parts.append(f"""{here}f as (select *, e1 - b1 as g1, e2 - b2 as g2, e3 - b3 as g3, {CHOLESKY_SQL}, g0 / l00 as y0, (g1 - l10 * y0) / l11 as y1, (g2 - l20 * y0 - l21 * y1) / l22 as y2, (g3 - l30 * y0 - l31 * y1 - l32 * y2) / l33 as y3,
  y3 / l33 as d3, (y2 - l32 * d3) / l22 as d2, (y1 - l21 * d2 - l31 * d3) / l11 as d1, (y0 - l10 * d1 - l20 * d2 - l30 * d3) / l00 as d0 from {here}s, {here})""")
        parts.append(f"{name}{i + 1} as materialized (select b0 + d0 as b0, b1 + d1 as b1, b2 + d2 as b2, b3 + d3 as b3 from {here}f)")
    return ",\n".join([*parts, f"{name} as (select * from {name}{NEWTON_STEPS})"])


FIRST_SQL = TRAINING_SQL + "dev as materialized (select x1, x2, x3, bad as y, 1.0 as w from z where _population = 'DEV'),\n" + _newton_sql("first", "dev")
FINAL_SQL = FIRST_SQL + f""",
rej as materialized (select x1, x2, x3, 1 / (1 + exp(-({MARGIN_SQL}))) as p from z, first where rejected),
aug as materialized (select * from dev union all select x1, x2, x3, 0.0, 1 - p from rej union all select x1, x2, x3, 1.0, p from rej),
""" + _newton_sql("final", "aug")  # fmt: skip


def _metrics_sql(model: str, name: str) -> str:
    """CTE ``<name>out``: metrics of a model on the funded populations, as ``passes_gate`` gives them."""
    rows = f"{name}x as (select _population as grp, bad, 1 / (1 + exp(-({MARGIN_SQL}))) as score from z, {model} where not rejected)"
    steps = ROC_SQL.format(by="grp", score="score").replace(", s as", f"{name}s as").replace("from x group", f"from {name}x group")
    for cte in ("c", "roc"):
        steps = steps.replace(f"\n{cte} as (", f"\n{name}{cte} as (")
    steps = steps.replace("from s)", f"from {name}s)").replace("from c group", f"from {name}c group")
    return f"{rows},\n{steps},\n{name}out as (select grp as _population, n, auc, gini, ks, coalesce(auc >= 0.55, false) as passes from {name}roc)"


@query(FIRST_SQL + ",\n" + _metrics_sql("first", "m1") + "\nselect * from m1out")
def logit_fit(spark, sf_dir):
    """Metrics of the first model on DEV, HOL and OOT, with the hold-out gate."""
    funded, _ = _training(spark, sf_dir)
    fitted = model.fit_logit(funded.where("_population = 'DEV'"), NUMERIC, CATEGORIES, "bad")
    return model.passes_gate(metrics.roc_metrics(model.probability(funded, fitted), "bad", "p_bad", ["_population"]))


@query(FINAL_SQL + f""",
p as (select o_orderkey, _population, 1 / (1 + exp(-({MARGIN_SQL}))) as p_bad from z, final),
q as (select *, cast(least(greatest(round_even(600 - 20 / ln(2) * ln(50) + 20 / ln(2) * ln((1 - p_bad) / greatest(p_bad, 1e-10)), 0), 0), 999) as int) as credit_score from p)
select o_orderkey, _population, round(p_bad, 6) as p_bad, credit_score, case when credit_score >= 750 then 'A1' when credit_score >= 700 then 'A2' when credit_score >= 650 then 'B1' when credit_score >= 600 then 'B2'
       when credit_score >= 550 then 'C1' when credit_score >= 500 then 'C2' else 'D' end as risk_grade from q""")
def reject_inference(spark, sf_dir):
    """Probabilities of every application by the model refitted on parcelled rejects."""
    funded, rejected = _training(spark, sf_dir)
    _, final = model.reject_inference(funded.where("_population = 'DEV'"), rejected, NUMERIC, CATEGORIES, "bad")
    return scorecard.score_columns(model.probability(funded.unionByName(rejected), final), "p_bad").select("o_orderkey", "_population", F.round("p_bad", 6).alias("p_bad"), "credit_score", "risk_grade")


@query(FINAL_SQL + ",\n" + _metrics_sql("first", "m1") + ",\n" + _metrics_sql("final", "m2") + "\nselect *, 'first' as model from m1out union all select *, 'final' from m2out")
def logit_final_metrics(spark, sf_dir):
    """Metrics of the model refitted on parcelled rejects, beside the first one's."""
    funded, rejected = _training(spark, sf_dir)
    first, final = model.reject_inference(funded.where("_population = 'DEV'"), rejected, NUMERIC, CATEGORIES, "bad")
    of = lambda name, fitted: model.passes_gate(metrics.roc_metrics(model.probability(funded, fitted), "bad", "p_bad", ["_population"])).withColumn("model", F.lit(name))
    return of("first", first).unionByName(of("final", final))


# Standard errors are square roots of the inverse's diagonal, that is of the squared columns of l's inverse; erf comes by its series of positive terms.
WALD_SQL = FIRST_SQL + f""",
pv as (select x1, x2, x3, p * (1 - p) as v from (select dev.*, 1 / (1 + exp(-({MARGIN_SQL}))) as p from dev, first)),
hs as (select {_information_sql()} from pv),
ls as (select *, {CHOLESKY_SQL}, 1 / l00 as i00, 1 / l11 as i11, 1 / l22 as i22, 1 / l33 as i33, -l10 * i00 / l11 as i10, -(l20 * i00 + l21 * i10) / l22 as i20, -l21 * i11 / l22 as i21,
  -(l30 * i00 + l31 * i10 + l32 * i20) / l33 as i30, -(l31 * i11 + l32 * i21) / l33 as i31, -l32 * i22 / l33 as i32 from hs),
w as (select unnest([{{'feature': 'intercept', 'b': b0, 'e': sqrt(i00 * i00 + i10 * i10 + i20 * i20 + i30 * i30)}}, {{'feature': 'o_totalprice', 'b': b1, 'e': sqrt(i11 * i11 + i21 * i21 + i31 * i31)}},
  {{'feature': 'c_acctbal', 'b': b2, 'e': sqrt(i22 * i22 + i32 * i32)}}, {{'feature': 'c_mktsegment', 'b': b3, 'e': i33}}], recursive := true) from ls, first)
select feature, round(b, 6) as coefficient, round(e, 6) as std_err, round(b / e, 4) as z,
  round(greatest(0, 1 - list_sum(list_transform(range(0, 300), lambda n: exp((2 * n + 1) * ln(abs(b / e) / sqrt(2)) - b * b / (e * e) / 2 - lgamma(n + 1.5))))), 4) as p_value,
  case when feature <> 'intercept' then round(exp(b), 4) end as odds_ratio from w"""


@query(WALD_SQL)
def wald_table(spark, sf_dir):
    funded, _ = _training(spark, sf_dir)
    dev = funded.where("_population = 'DEV'")
    table = model.wald_table(dev, model.fit_logit(dev, NUMERIC, CATEGORIES, "bad"), [*NUMERIC, *CATEGORIES])
    return table.select("feature", F.round("coefficient", 6).alias("coefficient"), F.round("std_err", 6).alias("std_err"), F.round("z", 4).alias("z"), F.round("p_value", 4).alias("p_value"), F.round("odds_ratio", 4).alias("odds_ratio"))


def metric_log(spark, sf_dir, rows: DataFrame | None = None) -> DataFrame:
    """Metrics of the stand-in score by population and its drift, as one run's log; ``rows``: the scored table, if it is there."""
    rows = rows if rows is not None else written(scored(spark, sf_dir))
    labelled_rows = rows.where(F.col("_observed_label").isNotNull()).withColumns({"bad": (F.col("_observed_label") == "Bad").cast("int"), "month": F.last_day("application_date")})
    points = metrics.score_points(labelled_rows, "bad", "p_bad", ["_population", "month"])
    log = metrics.metric_log(metrics.point_metrics(points, ["_population"]), "_population", ["auc", "gini", "ks"], "scorecard", "2024-02-01 00:00:00")
    by_month = metrics.mean_gini(metrics.point_metrics(points.where("month is not null"), ["month"]))
    log = log.unionByName(metrics.metric_log(by_month.select(F.lit("ALL").alias("_population"), F.col("weighted_gini").alias("weighted_gini_dp3")), "_population", ["weighted_gini_dp3"], "scorecard", "2024-02-01 00:00:00"))
    d = metrics.psi(rows, "final_p_good", "_population", "DEV").select(
        F.lit("scorecard").alias("model_name"), F.lit("2024-02-01 00:00:00").alias("run_timestamp"), F.col("_population").alias("population"), F.lit("psi_p_good").alias("metric"), F.col("psi").alias("value"), "alert_level"
    )
    return log.unionByName(d)


def _daily(spark, folder: str, sketches: DataFrame) -> DataFrame:
    """Sketches written a day at a time, as daily runs do, and read together (a few of the days, then all that is left)."""
    days = [r[0] for r in sketches.select("day").distinct().orderBy("day").collect()]  # the calendar
    for day in days[:3]:
        sketch.write_day(sketches, folder, day)
    sketches.where(~F.col("day").isin(days[:3])).write.mode("append").partitionBy("day").parquet(folder)
    return sketch.read_days(spark, folder)


@query(SCORED_SQL + """,
x as (select _population as grp, p_bad as score, (_observed_label = 'Bad')::int as bad from scored where _observed_label is not null and application_date between date '1995-01-01' and date '1998-12-31')"""
+ ROC_SQL.format(by="grp", score="score") + "select grp as _population, n, true as auc_close, true as ks_close from roc")
def monitor_window(spark, sf_dir):
    """Four years' metrics from daily sketches, and whether they are within 0.02 of the exact ones."""
    rows = written(scored(spark, sf_dir).where(F.col("_observed_label").isNotNull()).select("_population", "application_date", "p_bad", (F.col("_observed_label") == "Bad").cast("int").alias("bad")))
    months = rows.withColumn("application_date", F.trunc("application_date", "month"))
    daily = _daily(spark, f"{shared_folder(spark)}/sketches", sketch.score_sketches(months, "application_date", ["_population", "bad"], "p_bad"))
    found = sketch.window_roc(sketch.merged(daily, ["_population", "bad"], "1995-01-01", "1998-12-31"), "bad", ["_population"])
    exact = metrics.roc_metrics(rows.where(F.col("application_date").between(F.lit("1995-01-01").cast("date"), F.lit("1998-12-31").cast("date"))), "bad", "p_bad", ["_population"])
    exact = exact.select("_population", F.col("auc").alias("exact_auc"), F.col("ks").alias("exact_ks"))
    close = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) <= 0.02, F.lit(False))
    return found.join(exact, "_population").select("_population", "n", close("auc", "exact_auc").alias("auc_close"), close("ks", "exact_ks").alias("ks_close"))


@query(PSI_SQL + "select _population, true as psi_close from drift")
def monitor_drift(spark, sf_dir):
    """PSI from daily sketches, and whether it is within 0.01 of the exact one."""
    rows = written(scored(spark, sf_dir).select("_population", "application_date", "final_p_good"))
    months = rows.withColumn("application_date", F.trunc("application_date", "month"))
    daily = _daily(spark, f"{shared_folder(spark)}/sketches", sketch.score_sketches(months, "application_date", ["_population"], "final_p_good"))
    found = sketch.window_psi(sketch.merged(daily, ["_population"], "1900-01-01", "2100-01-01"), "_population", "DEV")
    exact = metrics.psi(rows, "final_p_good", "_population", "DEV").select("_population", F.col("psi").alias("exact"))
    return found.join(exact, "_population").select("_population", (F.abs(F.col("psi") - F.col("exact")) <= 0.01).alias("psi_close"))


@query("""
select 'user_id' as column_name, count(*) as rows, count(distinct user_id) as distinct_values, true as close from events where cast(ts as date) between date '2024-01-05' and date '2024-01-20'
union all select 'value', count(*), count(distinct value), true from events where cast(ts as date) between date '2024-01-05' and date '2024-01-20'""")
def distinct_days(spark, sf_dir):
    """Distinct values of a window from daily sketches, and whether they are within 5 % of the exact numbers."""
    events = load(spark, sf_dir, "events").select("ts", "user_id", "value")
    daily = _daily(spark, f"{shared_folder(spark)}/sketches", sketch.distinct_sketches(events, "ts", ["user_id", "value"]))
    found = sketch.distinct_between(daily, "2024-01-05", "2024-01-20")
    window = events.where(F.to_date("ts").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")))
    exact = window.agg(F.count_distinct("user_id").alias("user_id"), F.count_distinct("value").alias("value"))
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in ("user_id", "value")])))
    return found.join(exact, "column_name").select("column_name", "rows", "distinct_values", (F.abs(F.col("estimate") - F.col("distinct_values")) <= 0.05 * F.col("distinct_values")).alias("close"))


def evaluations(spark, sf_dir) -> DataFrame:
    """One evaluation row a model version: two stand-in scores."""
    rows = written(labelled(spark, sf_dir).select("bad", "c_acctbal", "o_totalprice"))
    parts = []
    for version, score in ((1, "c_acctbal"), (2, "o_totalprice")):
        parts.append(metrics.roc_metrics(rows, "bad", score).select(F.lit(version).cast("long").alias("challenger_version"), F.col("n").alias("eval_rows"), "auc", "gini", "ks"))
    return parts[0].unionByName(parts[1])


EVALUATION_SQL = X_SQL + ROC_SQL.format(by="1", score="o_totalprice") + ", " + "{months}, {segments}" + """,
s2 as (select c_acctbal as score, sum(bad) as p, count(*) - sum(bad) as q from x where c_acctbal is not null group by 1),
c2 as (select *, sum(q) over (order by score) as qc, sum(p) over () as pt, sum(q) over () as qt from s2),
g2 as (select round(2 * (sum(p * (qc - q / 2)) / (max(pt) * max(qt))) - 1, 4) as gini from c2),
d as (select o_totalprice / 1e6 as a, o_totalprice / 1e6 + c_acctbal / 1e5 as b from x where c_acctbal is not null)
select 'scorecard' as model_name, 2::bigint as challenger_version, 1::bigint as champion_version, '2024-02-01 00:00:00' as evaluation_timestamp, roc.n as eval_rows, roc.auc, roc.gini, roc.ks,
  m.w as weighted_gini_by_dp3, k.w as weighted_gini_by_pop, (select round(corr(a, b), 4) from d) as sas_correlation, (select round(avg(a - b), 4) from d) as sas_mean_diff, (select round(max(abs(a - b)), 4) from d) as sas_max_abs_diff,
  g2.gini as champion_gini, case when roc.gini >= g2.gini then 'passed' else 'failed' end as comparison_result from roc, g2, m, k"""


def _weighted_sql(name: str, by: str) -> str:
    return f"""{name}s as (select {by} as grp, o_totalprice as score, sum(bad) as p, count(*) - sum(bad) as q from x group by all),
{name}c as (select *, sum(q) over (partition by grp order by score) as qc, sum(p) over (partition by grp) as pt, sum(q) over (partition by grp) as qt from {name}s),
{name}g as (select grp, sum(p + q) as n, case when max(pt) > 0 and max(qt) > 0 then round(2 * (sum(p * (qc - q / 2)) / (max(pt) * max(qt))) - 1, 4) end as gini from {name}c group by grp),
{name} as (select round(sum(n * gini) / sum(n), 4) as w from {name}g where gini is not null)"""


@query(EVALUATION_SQL.replace("{months}", _weighted_sql("m", "last_day(cast(o_orderdate as date))")).replace("{segments}", _weighted_sql("k", "c_mktsegment")))
def evaluation_record(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumn("month", F.last_day(F.to_date("o_orderdate")))
    overall = metrics.roc_metrics(rows, "bad", "o_totalprice")
    a = F.col("o_totalprice") / 1e6
    agreement = metrics.reconcile(rows.withColumns({"a": a, "b": a + F.col("c_acctbal") / 1e5}), "a", "b")
    compared = metrics.compare_models(overall, metrics.roc_metrics(rows, "bad", "c_acctbal"))
    by = lambda key: metrics.weighted_gini(rows, "bad", "o_totalprice", key)
    return metrics.evaluation_record(overall, by("month"), by("c_mktsegment"), agreement, compared, "scorecard", 2, 1, "2024-02-01 00:00:00")
