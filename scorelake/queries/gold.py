"""Mart, joins, split of populations, and lending functions over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lending
from ..operators import split, standardize
from ..plans import mart, reports
from ..sources.tables import load
from . import query
from .folders import shared_folder

DECISION = "case o_orderstatus when 'P' then 'DECLINED' else 'APPROVED' end"


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("application_id"), F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("application_date"),
        F.col("o_totalprice").alias("amount"), F.expr(DECISION).alias("decision"), "o_orderstatus", F.col("o_orderpriority").alias("priority"),
    )


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("application_id"), F.round(F.col("l_discount") * 1000).cast("int").alias("arrears"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.08), "Y").otherwise("N").alias("hardship"),
        lending.months_between_starts(F.col("l_shipdate"), F.col("o_orderdate")).alias("months"), F.to_date("l_shipdate").alias("snapshot"),
    )
    return mart.performance_window(rows, "application_id", "months", "arrears", "hardship", "snapshot")


def dimensions(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, list[str]]]:
    customer = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    nation = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"), F.col("n_regionkey").alias("r_regionkey"))
    region = load(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    return [(customer, ["c_custkey"]), (nation, ["n_nationkey"]), (region, ["r_regionkey"])]


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.application_mart(applications(spark, sf_dir), dimensions(spark, sf_dir), performance(spark, sf_dir), "application_id", "decision", "application_date")


GOLD_SQL = """
with perf as (
  select l_orderkey as application_id, max(cast(round(l_discount * 1000) as int)) as max_arrears,
         max(case when l_returnflag = 'R' and l_tax >= 0.08 then 1 else 0 end) as hardship, count(*) as perf_observations,
         max(cast(l_shipdate as date)) as last_observed_date
  from lineitem join orders on l_orderkey = o_orderkey
  where (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) <= 24
  group by 1),
gold as (
  select o_orderkey as application_id, cast(o_orderdate as date) as application_date, o_totalprice as amount, o_orderstatus, o_orderpriority as priority,
         c_mktsegment as segment, c_acctbal as balance, n_name as nation, r_name as region, max_arrears, hardship, perf_observations, last_observed_date,
         case when o_orderstatus = 'P' then 'DECLINED' else 'APPROVED' end as decision,
         case when o_orderstatus = 'P' then 'Rejected' when max_arrears >= 90 or hardship = 1 then 'Bad' when max_arrears = 0 then 'Good'
              when max_arrears >= 1 then 'Indeterminate' else 'NotFunded' end as target_flag,
         case when o_orderstatus <> 'P' then 'Funded' else 'NotFunded' end as sample_flag,
         last_day(cast(o_orderdate as date)) as dp3_application
  from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
       left join region on n_regionkey = r_regionkey left join perf on perf.application_id = o_orderkey)
"""


@query(GOLD_SQL + "select target_flag, sample_flag, count(*) as n, round(avg(max_arrears), 4) as avg_arrears from gold group by all")
def gold_target_distribution(spark, sf_dir):
    return gold(spark, sf_dir).groupBy("target_flag", "sample_flag").agg(F.count("*").alias("n"), F.round(F.avg("max_arrears_days_24mo"), 4).alias("avg_arrears"))


GOLD_COLUMNS = ["application_id", "application_date", "decision", "segment", "nation", "region", "last_observed_date", "target_flag", "sample_flag", "dp3_application"]


@query(GOLD_SQL + f"select {', '.join(GOLD_COLUMNS)}, cast(max_arrears as double) as max_arrears, cast(hardship as double) as hardship, cast(perf_observations as double) as perf_observations from gold")
def gold_application_mart(spark, sf_dir):
    performance = {"max_arrears": "max_arrears_days_24mo", "hardship": "hardship_ever_24mo", "perf_observations": "perf_observations"}
    return gold(spark, sf_dir).select(*GOLD_COLUMNS, *[F.col(c).cast("double").alias(name) for name, c in performance.items()])


FACILITY_SQL = """
with bridge as (select l_orderkey as application_id, min(l_partkey) as facility_key, min(cast(l_shipdate as date)) as funded_date from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'P' group by 1),
perf as (select l_partkey as facility_key, max(cast(round(l_discount * 1000) as int)) as arrears, max(case when l_returnflag = 'R' and l_tax >= 0.08 then 1 else 0 end) as hardship, count(*) as n
         from lineitem join orders on l_orderkey = o_orderkey where (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) <= 24 group by 1)
select o_orderkey as application_id, funded_date, p_name as facility_id, p_retailprice as loan_amount_funded, p_size as loan_term_months, n as perf_observations,
  case when o_orderstatus = 'P' then 'Rejected' when arrears >= 90 or hardship = 1 then 'Bad' when arrears = 0 then 'Good' when arrears >= 1 then 'Indeterminate' else 'NotFunded' end as target_flag
from orders left join bridge on bridge.application_id = o_orderkey left join part on p_partkey = facility_key left join perf on perf.facility_key = bridge.facility_key
"""


def facility_leg(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bridge (an application's facility), facility dimension, and the facilities' performance."""
    apps = applications(spark, sf_dir)
    approved = apps.where("decision = 'APPROVED'").select("application_id", "application_date")
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("application_id"), F.col("l_partkey").alias("facility_key"), "l_discount", "l_tax", "l_returnflag", F.to_date("l_shipdate").alias("l_shipdate"))
    bridge = lines.join(approved, "application_id").groupBy("application_id").agg(F.min("facility_key").alias("facility_key"), F.min("l_shipdate").alias("funded_date"))
    facility = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("facility_key"), F.col("p_name").alias("facility_id"), F.col("p_retailprice").alias("loan_amount_funded"), F.col("p_size").alias("loan_term_months"))
    rows = lines.join(apps.select("application_id", "application_date"), "application_id").select(
        "facility_key", F.round(F.col("l_discount") * 1000).cast("int").alias("arrears"), F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.08), "Y").otherwise("N").alias("hardship"),
        lending.months_between_starts(F.col("l_shipdate"), F.col("application_date")).alias("months"), F.col("l_shipdate").alias("snapshot"),
    )
    return bridge, facility, mart.performance_window(rows, "facility_key", "months", "arrears", "hardship", "snapshot")


@query(FACILITY_SQL)
def gold_facility_mart(spark, sf_dir):
    """Applications by way of a bridge to their facility, and the facility's performance."""
    joined = mart.facilities(applications(spark, sf_dir), *facility_leg(spark, sf_dir), "application_id", "facility_key")
    built = mart.with_flags(joined, "decision", "application_date")
    return built.select("application_id", "funded_date", "facility_id", "loan_amount_funded", "loan_term_months", "perf_observations", "target_flag")


def full(spark, sf_dir) -> DataFrame:
    return mart.full_mart(applications(spark, sf_dir), dimensions(spark, sf_dir), *facility_leg(spark, sf_dir), "application_id", "facility_key", "decision", "application_date")


FULL_SQL = FACILITY_SQL.replace("select o_orderkey as application_id, funded_date", """select o_orderkey as application_id, cast(o_orderdate as date) as application_date, c_mktsegment as segment, n_name as nation, r_name as region, c_acctbal as balance,
  case when o_orderstatus <> 'P' then 'Funded' else 'NotFunded' end as sample_flag, last_day(cast(o_orderdate as date)) as dp3_application, arrears as max_arrears_days_24mo, hardship as hardship_ever_24mo, funded_date""").replace(
    "from orders left join bridge", "from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey left join bridge"
)
FULL_COLUMNS = [
    "application_id", "application_date", "segment", "nation", "region", "balance", "sample_flag", "dp3_application", "max_arrears_days_24mo", "hardship_ever_24mo", "funded_date", "facility_id",
    "loan_amount_funded", "loan_term_months", "perf_observations", "target_flag",
]


@query(FULL_SQL)
def gold_full_mart(spark, sf_dir):
    """Dimensions and facility leg in one table."""
    return full(spark, sf_dir).select(*FULL_COLUMNS)


@query("select count(*) as source_rows, count(*) as target_rows, true as matches from orders")
def gold_mart_grain(spark, sf_dir):
    """The mart as written has the fact's rows."""
    return mart.write_mart(full(spark, sf_dir), applications(spark, sf_dir), f"{shared_folder(spark)}/mart")


@query("""
with f as (select l_orderkey, max(case when l_returnflag = 'R' then 'Y' else 'N' end) as hardship, max(cast(round(l_discount * 1000) as int)) as days from lineitem group by 1)
select case when days >= 90 or hardship = 'Y' then 'Bad' when days = 0 then 'Good' when days >= 1 then 'Indeterminate' else 'NotFunded' end as target_flag,
       count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 2) as pct
from orders left join f on l_orderkey = o_orderkey group by 1""")
def two_table_target(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_returnflag") == "R", "Y").otherwise("N")).alias("hardship"), F.max(F.round(F.col("l_discount") * 1000).cast("int")).alias("days"))
    joined = load(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    flagged = joined.withColumn("target_flag", lending.target_flag(F.lit(False), F.col("days"), (F.col("hardship") == "Y").cast("int")))
    return reports.share_of_total(flagged, "target_flag")


@query("select last_day(cast(o_orderdate as date)) as dp3_application, count(*) as n from orders group by 1")
def gold_month_end(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy(lending.month_end(F.col("o_orderdate")).alias("dp3_application")).agg(F.count("*").alias("n"))


@query("""
select (select count(distinct o_orderkey) from orders join customer on o_custkey = c_custkey) as orders_with_customer,
       (select count(*) from orders where not exists (select 1 from customer where c_custkey = o_custkey)) as orphan_orders,
       (select count(l.quality) from documents d left join labels l on d.doc_id = l.doc_id) as labelled_documents,
       (select count(*) from documents d left join labels l on d.doc_id = l.doc_id) as documents""")
def join_coverage(spark, sf_dir):
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    documents, labels = load(spark, sf_dir, "documents").select("doc_id"), load(spark, sf_dir, "labels").select("doc_id", "quality")
    on = F.col("o_custkey") == F.col("c_custkey")
    parts = [
        orders.join(customer, on).agg(F.count_distinct("o_orderkey").alias("orders_with_customer")),
        orders.join(customer, on, "left_anti").agg(F.count("*").alias("orphan_orders")),
        documents.join(labels, "doc_id", "left").agg(F.count("quality").alias("labelled_documents"), F.count("*").alias("documents")),
    ]
    first, *rest = [p.withColumn("_k", F.lit(1)) for p in parts]  # single rows
    for p in rest:
        first = first.join(F.broadcast(p), "_k")
    return first.drop("_k")


@query("""
with k as (select l_orderkey as key from lineitem where l_quantity >= 49 union select o_orderkey from orders where o_totalprice < 20000)
select o_orderkey, o_orderstatus, round(o_totalprice, 2) as o_totalprice from orders where o_orderkey in (select key from k)""")
def semi_key_restrict(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    big = load(spark, sf_dir, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    keys = big.union(orders.where("o_totalprice < 20000").select("o_orderkey")).distinct()
    return orders.join(keys, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("select c_custkey as cust_key, c_name as customer_name, c_nationkey as nation_id, c_acctbal as acct_bal from customer")
def standardize_names(spark, sf_dir):
    """One half of the rows gets its names cleaned, the other those that the first was given."""
    messy = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust  Key"), F.col("c_name").alias("_CUSTOMER-name_"), F.col("c_nationkey").alias("nation.id"), F.col("c_acctbal").alias("acct--Bal!")
    )
    odd = F.col("`Cust  Key`") % 2 == 1
    clean, renames = standardize.clean_names(messy.where(odd))
    return standardize.apply_renames(messy.where(~F.coalesce(odd, F.lit(False))), renames).unionByName(clean)


@query("""
select o_orderkey as id, case when o_orderkey % 2 = 0 then cast(o_orderdate as timestamp) else cast(cast(o_orderdate as date) as timestamp) end as placed,
       cast(round(o_totalprice) as bigint) as total, cast(null as varchar) as note, upper(hex(o_orderstatus)) as status, md5(trim(o_orderpriority)) as priority
from orders""")
def align_schema(spark, sf_dir):
    from pyspark.sql import types as T

    raw = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("placed"),
        F.round("o_totalprice").alias("total"), F.col("o_orderstatus").cast("binary").alias("status"), F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("priority"),
    )
    wanted = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("placed", T.TimestampNTZType()), T.StructField("total", T.LongType()), T.StructField("note", T.StringType()),
        T.StructField("status", T.StringType()), T.StructField("priority", T.StringType()),
    ])
    aligned = standardize.align_schema(standardize.trim_columns(standardize.hex_binary(raw), ["priority"]), wanted)
    return aligned.withColumn("priority", F.md5("priority"))


def populated(spark, sf_dir) -> DataFrame:
    apps = applications(spark, sf_dir)
    cut = split.out_of_time_cut(apps, "application_date", 4)
    return split.populations(apps, "application_id", "application_date", F.col("decision") == "APPROVED", cut)


POPULATION_SQL = """
with pop as (
  select o_orderkey as application_id, o_custkey, cast(o_orderdate as date) as application_date, o_totalprice, o_orderstatus, o_orderpriority,
    case when o_orderstatus = 'P' then 'TTD'
         when cast(o_orderdate as date) >= (select max(cast(o_orderdate as date)) - interval 4 month from orders) then 'OOT'
         when ('0x' || substr(md5('42|' || cast(o_orderkey as varchar)), 1, 7))::bigint < cast(floor(0.7 * 268435456) as bigint) then 'DEV' else 'HOL' end as _population
  from orders)
"""


@query(POPULATION_SQL + "select application_id, _population from pop")
def population_split(spark, sf_dir):
    return populated(spark, sf_dir).select("application_id", "_population")


@query(POPULATION_SQL + "select _population, o_orderstatus, count(*) as n from pop group by all")
def population_target_counts(spark, sf_dir):
    return reports.distribution(populated(spark, sf_dir), "_population", "o_orderstatus")


@query("""
with b as (select o_orderkey, o_orderstatus, ('0x' || substr(md5('42|' || cast(o_orderkey as varchar)), 1, 7))::bigint as b from orders)
select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by b, o_orderkey) <= floor(count(*) over (partition by o_orderstatus) * 0.7) as chosen from b""")
def stratified_quota(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return split.exact_quota(orders, "o_orderkey", ["o_orderstatus"], 0.7).withColumnRenamed("_chosen", "chosen")


BUCKET_SQL = "('0x' || substr(md5('42|' || cast(o_orderkey as varchar)), 1, 7))::bigint"


@query(f"select o_orderkey, o_orderstatus from orders where {BUCKET_SQL} < case o_orderstatus when 'F' then floor(0.5 * 268435456) when 'O' then floor(0.25 * 268435456) when 'P' then floor(0.9 * 268435456) else 0 end")
def sample_levels(spark, sf_dir):
    """A rate for each of three levels."""
    return split.sample_levels(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", {"F": 0.5, "O": 0.25, "P": 0.9})


@query(f"""
select o_orderkey, o_orderstatus from (select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by {BUCKET_SQL}, o_orderkey) as nth from orders)
where nth <= case o_orderstatus when 'F' then 300 when 'O' then 77 when 'P' then 100000000 else 0 end""")
def sample_quota(spark, sf_dir):
    """300 and 77 rows of two levels, and all of a third."""
    return split.sample_quota(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", {"F": 300, "O": 77, "P": 100_000_000})


@query("""
with b as (select last_day(cast(o_orderdate as date)) as d from orders)
select strftime(d, '%Y%m') as snapshot_key, d as snapshot_date, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
       strftime(d, '%Y-%m') as year_month, case when month(d) % 3 = 0 then 'Y' else 'N' end as is_quarter_end
from (select last_day(cast(unnest(generate_series(date_trunc('month', min(d)), date_trunc('month', max(d)), interval 1 month)) as date)) as d from b)""")
def calendar_dim(spark, sf_dir):
    bounds = load(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last"))
    return lending.calendar(spark, bounds)


@query("""
with d as (select cast(round(l_discount * 1000) as int) as days, case when l_returnflag = 'R' and l_tax >= 0.08 then 'Y' else 'N' end as h from lineitem)
select case when days <= 0 then '0' when days <= 30 then '1-30' when days <= 60 then '31-60' when days < 90 then '61-89' else '90+' end as bucket,
       case when h = 'Y' then 'HARDSHIP' when days = 0 then 'CURRENT' when days >= 90 then 'DEFAULT' else 'ARREARS_' || days end as status, count(*) as n
from d group by all""")
def dpd_bucket(spark, sf_dir):
    days = F.round(F.col("l_discount") * 1000).cast("int")
    hardship = F.when((F.col("l_returnflag") == "R") & (F.col("l_tax") >= 0.08), "Y").otherwise("N")
    rows = load(spark, sf_dir, "lineitem").select(lending.days_past_due_bucket(days).alias("bucket"), lending.payment_status(days, hardship).alias("status"))
    return rows.groupBy("bucket", "status").agg(F.count("*").alias("n"))


@query("""
with t as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice as p, l_tax as rate, 12 * (1 + l_linenumber % 5) as months, cast(round(l_discount * 1000) as int) as days from lineitem),
m as (select *, round(case when rate / 12 = 0 then p / months else p * (rate / 12) / (1 - pow(1 + rate / 12, -months)) end, 2) as payment from t)
select months, days, count(*) as n, round(avg(payment), 1) as avg_payment, round(avg(round(payment * days / 30, 2)), 1) as avg_arrears from m group by all""")
def amortise(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("p"), F.col("l_tax").alias("rate"), (12 * (1 + F.col("l_linenumber") % 5)).alias("months"), F.round(F.col("l_discount") * 1000).cast("int").alias("days")
    )
    paid = rows.withColumn("payment", lending.level_payment(F.col("p"), F.col("rate"), F.col("months"))).withColumn("arrears", lending.arrears_amount(F.col("payment"), F.col("days")))
    return paid.groupBy("months", "days").agg(F.count("*").alias("n"), F.round(F.avg("payment"), 1).alias("avg_payment"), F.round(F.avg("arrears"), 1).alias("avg_arrears"))


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  round(greatest(0.0, o_totalprice - sum(l_extendedprice) over (partition by l_orderkey order by l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice rows unbounded preceding)), 2) as balance
from lineitem join orders on l_orderkey = o_orderkey""")
def running_balance(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    order = [F.col(c) for c in ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    done = lending.running_balance(lines.join(orders, "l_orderkey"), ["l_orderkey"], order, F.col("o_totalprice"), F.col("l_extendedprice"))
    return done.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "balance")
