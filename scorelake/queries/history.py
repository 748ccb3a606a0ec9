"""Incremental ingestion, hashes, versions and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, scd2, standardize
from ..sources import generations, ingest
from ..sources.tables import current_view, load
from . import query
from .folders import shared_folder

CUT, LAST = "2024-01-01 12:00:00", "2024-01-20 00:00:00"
NOW = "2024-02-01 00:00:00"


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(28,4)").alias("value"))


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("user_id", "ts", "event_type", "value")


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) as l_shipdate, l_quantity from (
  select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice) as n from lineitem) where n = 1""")
def latest_per_key(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
    order = [F.desc_nulls_last("l_shipdate"), *map(F.col, ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))]
    latest = scd2.latest_per_key(lines, ["l_orderkey", "l_linenumber"], order)
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("l_shipdate"), "l_quantity")


def _hash_sql(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce({c}, chr(0))" for c in columns)
    return f"md5(concat_ws(chr(31), {parts}))"


@query(f"""
select 'customer' as source, c_custkey as id, {_hash_sql(["cast(cast(c_acctbal as decimal(28,4)) as varchar)", "cast(c_custkey as varchar)", "c_mktsegment", "c_name", "cast(c_nationkey as varchar)"])} as row_hash from customer
union all
select 'orders', o_orderkey, {_hash_sql(["cast(o_custkey as varchar)", "cast(cast(o_orderdate as timestamp) as varchar)", "cast(o_orderkey as varchar)", "o_orderpriority", "o_orderstatus", "cast(cast(o_totalprice as decimal(28,4)) as varchar)"])} from orders""")
def row_hash(spark, sf_dir):
    customer, orders = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    a = customer.select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), scd2.row_hash(customer).alias("row_hash"))
    return a.unionByName(orders.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), scd2.row_hash(orders).alias("row_hash")))


@query(f"""
select event_id, user_id, event_type, cast('{NOW}' as timestamp) as _ingested_at, 'mart' as _source_system, 'events' as _source_table, 'incremental' as _load_type, 'run-2' as _ingestion_id
from events where ts > (select max(ts) from events where ts < timestamp '{CUT}')""")
def incremental_batch(spark, sf_dir):
    source = events(spark, sf_dir)
    batch, kind = ingest.incremental_batch(source, source.where(F.col("ts") < ntz(CUT)), "ts")
    return ingest.stamp_audit(batch, "mart", "events", kind, "run-2", ntz(NOW)).drop("ts", "value")


@query(f"""
with base as (select event_type as table_name, max(ts) as mark, count(*) as n from events where ts < timestamp '{CUT}' group by 1),
     run as (select event_type as table_name, max(ts) as mark, count(*) as n, event_type = 'error' as failed from events where ts >= timestamp '{CUT}' group by 1)
select coalesce(b.table_name, r.table_name) as table_name, 'bronze' as layer, case when r.mark is not null and not failed then r.mark else b.mark end as last_processed_watermark,
  case when r.mark is null then 'SUCCESS' when failed then 'FAILED' else 'SUCCESS' end as last_run_status, case when r.mark is null then timestamp '{CUT}' else timestamp '{NOW}' end as last_run_timestamp,
  case when r.mark is not null and not failed then r.n else b.n end as rows_processed, case when r.mark is null then 'run-1' else 'run-2' end as run_id
from base b full join run r on b.table_name = r.table_name where b.table_name is not null or not failed""")
def control_upsert(spark, sf_dir):
    def runs(rows: DataFrame, status, at: str, run: str) -> DataFrame:
        marks = rows.groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("last_processed_watermark"), F.count("*").alias("rows_processed"))
        return marks.select("table_name", F.lit("bronze").alias("layer"), "last_processed_watermark", status.alias("last_run_status"), ntz(at).alias("last_run_timestamp"), "rows_processed", F.lit(run).alias("run_id"))

    rows = events(spark, sf_dir)
    first = ingest.next_control(ingest.empty_control(spark), runs(rows.where(F.col("ts") < ntz(CUT)), F.lit("SUCCESS"), CUT, "run-1"))
    failed = F.when(F.col("table_name") == "error", "FAILED").otherwise("SUCCESS")
    return ingest.control_status(ingest.next_control(first, runs(rows.where(F.col("ts") >= ntz(CUT)), failed, NOW, "run-2")))


EVENT_HASH = "md5(concat_ws(chr(31), coalesce(event_type, chr(0)), cast(user_id as varchar), coalesce(cast(cast(value as decimal(28,4)) as varchar), chr(0))))"
LOG_SQL = f"""
with e as (select user_id, ts, event_type, cast(value as decimal(28,4)) as value, {EVENT_HASH} as h from events),
l as (select *, lag(h) over (partition by user_id order by ts) as p from e),
v as (select user_id, event_type, value, h as _row_hash, ts as _effective_from, lead(ts) over (partition by user_id order by ts) as _effective_to from l where h is distinct from p),
log as (select *, _effective_to is null as _is_current from v)
"""
VERSION_COLUMNS = ["user_id", "event_type", "value", "_row_hash", "_effective_from", "_effective_to", "_is_current"]


def version_log(spark, sf_dir) -> DataFrame:
    return scd2.from_log(states(spark, sf_dir), ["user_id"], "ts").select(*[F.col(c).cast("double").alias(c) if c == "value" else c for c in VERSION_COLUMNS])


SQL_COLUMNS = ", ".join("cast(value as double) as value" if c == "value" else c for c in VERSION_COLUMNS)


@query(LOG_SQL + f"select {SQL_COLUMNS} from log")
def scd2_from_log(spark, sf_dir):
    return version_log(spark, sf_dir)


@query(LOG_SQL + f"select {SQL_COLUMNS} from log where _effective_from <= timestamp '{LAST}' and (_effective_to is null or _effective_to > timestamp '{LAST}')")
def scd2_as_of(spark, sf_dir):
    return scd2.as_of(version_log(spark, sf_dir), ntz(LAST))


@query(LOG_SQL + f"select {SQL_COLUMNS} from log where user_id = (select min(user_id) from events)")
def scd2_key_history(spark, sf_dir):
    first = load(spark, sf_dir, "events").agg(F.min("user_id")).first()[0]
    return scd2.key_history(version_log(spark, sf_dir), F.col("user_id") == first)


@query(LOG_SQL + "select user_id, event_type, cast(value as double) as value from log where _is_current")
def silver_current(spark, sf_dir):
    return current_view(version_log(spark, sf_dir))


APPLY_SQL = f"""
with e as (select user_id, ts, event_type, cast(value as decimal(28,4)) as value, {EVENT_HASH} as h from events),
base as (select * from (select *, row_number() over (partition by user_id order by ts desc) as n from e where ts < timestamp '{CUT}') where n = 1),
batch as (select * from (select *, row_number() over (partition by user_id order by ts desc) as n from e where ts >= timestamp '{CUT}') where n = 1),
out as (
  select b.user_id, b.event_type, b.value, b.h as _row_hash, b.ts as _effective_from,
    case when c.h is not null and (c.h <> b.h or {{deleted}}) then {{end}} end as _effective_to, not (c.h is not null and (c.h <> b.h or {{deleted}})) as _is_current
  from base b left join batch c on b.user_id = c.user_id
  union all
  select c.user_id, c.event_type, c.value, c.h, c.ts, null, true from batch c left join base b on b.user_id = c.user_id where (b.h is null or b.h <> c.h) and not {{deleted}})
"""


def applied(spark, sf_dir, close_at: str, delete_when=None, table_only: bool = False) -> DataFrame:
    rows, order = states(spark, sf_dir), [F.desc("ts")]
    ready = lambda df: scd2.versioned(df, ["user_id"], "ts", order, ntz(NOW)).drop("ts")
    base = ready(rows.where(F.col("ts") < ntz(CUT)))
    batch = ready(rows.where(F.col("ts") >= ntz(CUT)))
    out = scd2.apply(base, batch, ["user_id"], ntz(NOW), close_at, delete_when)
    return out if table_only else out.withColumn("value", F.col("value").cast("double"))


def _apply_sql(end: str, deleted: str = "false") -> str:
    return APPLY_SQL.format(end=end, deleted=deleted)


@query(_apply_sql("c.ts") + f"select {SQL_COLUMNS} from out")
def scd2_apply(spark, sf_dir):
    return applied(spark, sf_dir, "business")


@query(_apply_sql(f"timestamp '{NOW}'") + f"select {SQL_COLUMNS} from out")
def scd2_apply_processing(spark, sf_dir):
    return applied(spark, sf_dir, "processing")


@query(_apply_sql("c.ts", "c.event_type = 'error'") + f"select {SQL_COLUMNS} from out")
def scd2_delete(spark, sf_dir):
    return applied(spark, sf_dir, "business", F.col("event_type") == "error")


@query(_apply_sql("c.ts") + "select count(*) filter (_is_current) as current_rows, count(*) filter (not _is_current) as historical_rows, count(*) as total_rows from out")
def scd2_summary(spark, sf_dir):
    return scd2.summary(applied(spark, sf_dir, "business", table_only=True))


@query(_apply_sql("c.ts") + """select count(*) filter (b.h is null) as new_rows, count(*) filter (b.h <> c.h) as changed_rows, count(*) filter (b.h = c.h) as unchanged_rows
from batch c left join base b on b.user_id = c.user_id""")
def scd2_change_counts(spark, sf_dir):
    rows, order = states(spark, sf_dir), [F.desc("ts")]
    ready = lambda df: scd2.versioned(df, ["user_id"], "ts", order, ntz(NOW)).drop("ts")
    return scd2.change_counts(scd2.judge(ready(rows.where(F.col("ts") < ntz(CUT))), ready(rows.where(F.col("ts") >= ntz(CUT))), ["user_id"]))


ALL_COUNTS_SQL = _apply_sql("c.ts") + """select count(*) filter (b.h is null and c.event_type <> 'error') as new_rows, count(*) filter (b.h <> c.h and c.ts >= b.ts and c.event_type <> 'error') as changed_rows,
  count(*) filter (b.h = c.h and c.ts >= b.ts and c.event_type <> 'error') as unchanged_rows, count(*) filter (c.ts < b.ts) as late_rows, count(*) filter (c.ts >= b.ts and c.event_type = 'error') as deleted_rows,
  count(*) filter (b.h is null and c.event_type = 'error') as none_rows, count(*) as batch_rows from batch c left join base b on b.user_id = c.user_id"""


@query(ALL_COUNTS_SQL.replace(f"where ts < timestamp '{CUT}'", "where event_id % 2 = 0").replace(f"where ts >= timestamp '{CUT}'", "where event_id % 2 = 1").replace("(select user_id, ts, event_type,", "(select event_id, user_id, ts, event_type,"))
def scd2_all_change_counts(spark, sf_dir):
    """Events of odd ids as a batch onto those of even ids, so that about half of it is late."""
    rows = events(spark, sf_dir)
    ready = lambda df: scd2.versioned(df.drop("event_id"), ["user_id"], "ts", [F.desc("ts")], ntz(NOW)).drop("ts")
    odd = F.col("event_id") % 2 == 1
    return scd2.all_change_counts(scd2.judge(ready(rows.where(~odd)), ready(rows.where(odd)), ["user_id"], F.col("event_type") == "error"))


def in_any_order(spark, sf_dir, path: str, keep: tuple[str, ...] = ()) -> list[set[int]]:
    """Splice four slices of the events into a table in buckets, so that most rows come late; the buckets that each slice touched."""
    slice_of = F.pmod(F.xxhash64("event_id"), F.lit(4))
    rows = events(spark, sf_dir)
    into = lambda old, log: scd2.splice(old, log, ["user_id"], "ts")
    return [generations.merge(spark, path, rows.where(slice_of == i).select("user_id", "ts", "event_type", "value", *keep), ["user_id"], into, buckets=16) for i in (2, 0, 3, 1)]


@query(LOG_SQL + f"select {SQL_COLUMNS} from log")
def scd2_late(spark, sf_dir):
    path = f"{shared_folder(spark)}/spliced"
    in_any_order(spark, sf_dir, path)
    versions = scd2.spliced_versions(generations.read(spark, path))
    return versions.select(*[F.col(c).cast("double").alias(c) if c == "value" else c for c in VERSION_COLUMNS])


@query(f"""
select o_orderkey, case when o_orderkey % 97 = 0 then 'X' else o_orderstatus end as o_orderstatus, round(case when o_orderkey % 97 = 0 then o_totalprice * 2 else o_totalprice end, 2) as o_totalprice from orders
union all select -o_orderkey, o_orderstatus, round(o_totalprice, 2) from orders where o_orderkey % 89 = 0 and o_orderkey > 0""")
def upsert_buckets(spark, sf_dir):
    """Some orders replaced and some added; only the buckets of their keys are written again."""
    path = f"{shared_folder(spark)}/orders"
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))
    changed = orders.where("o_orderkey % 97 = 0").withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.round(F.col("o_totalprice") * 2, 2)})
    added = orders.where("o_orderkey % 89 = 0 and o_orderkey > 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    for rows in (orders, changed, added):
        generations.merge(spark, path, rows, ["o_orderkey"], lambda old, new: generations.replace_keys(old, new, ["o_orderkey"]))
    generations.vacuum(spark, path)
    return generations.read(spark, path)


@query(f"""
select event_id, user_id, event_type, 'UPSERT' as _operation, value is null as no_value from events where ts >= timestamp '{CUT}'
union all select event_id, user_id, event_type, 'HISTORY', true from events where ts < timestamp '{CUT}'""")
def history_union(spark, sf_dir):
    rows = events(spark, sf_dir)
    history = rows.where(F.col("ts") < ntz(CUT)).drop("value")
    both = standardize.union_history(rows.where(F.col("ts") >= ntz(CUT)), history)
    return both.select("event_id", "user_id", "event_type", "_operation", F.col("value").isNull().alias("no_value"))


@query(f"""
select o_orderkey, {_hash_sql(["cast(o_custkey as varchar)", "cast(o_orderkey as varchar)", "o_orderpriority", "o_orderstatus"])} as _row_hash, true as _is_current, timestamp '{NOW}' as _effective_from from orders""")
def backfill_versions(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    done = scd2.backfill_versions(orders.dropDuplicates(), ntz(NOW))
    return done.select("o_orderkey", "_row_hash", "_is_current", "_effective_from")


@query("""
with s as (select count(*) as n, count(*) filter (l_discount is null) as nulls, count(distinct (l_orderkey, l_linenumber)) as k, min(l_discount) as lo, max(l_discount) as hi, count(*) filter (l_returnflag = 'R') as bad, count(*) filter (l_returnflag = 'N') as good, avg(l_discount) as av from lineitem)
select 'row_count' as check_name, '*' as column_name, n >= 1000 as passed, cast(n as double) as value from s
union all select 'required', 'l_orderkey', true, 1.0 from s union all select 'required', 'l_missing', false, 0.0 from s
union all select 'not_null', 'l_discount', nulls = 0, cast(nulls as double) from s union all select 'null_pct', 'l_discount', nulls = 0, round(nulls * 100.0 / n, 5) from s
union all select 'unique', 'l_orderkey,l_linenumber', n = k, cast(n - k as double) from s
union all select 'range_min', 'l_discount', lo >= 0.0, lo from s union all select 'range_max', 'l_discount', hi <= 0.05, hi from s
union all select 'range_avg', 'l_discount', true, round(av, 5) from s
union all select 'bad_share', 'l_returnflag', bad * 100.0 / n between 1 and 50, round(bad * 100.0 / n, 5) from s
union all select 'good_bad_ratio', 'l_returnflag', true, round(good / nullif(bad, 0), 5) from s""")
def dq_suite(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    checks = quality.run_checks(
        lines, 1000, ("l_discount", "l_gone"), ("l_orderkey", "l_missing"), ("l_orderkey", "l_linenumber"), {"l_discount": (0.0, 0.05)}, ("l_returnflag", "R", "N")
    )
    return checks.withColumn("value", F.round("value", 5))


@query("""
with s as (select count(*) as n, count(*) filter (l_quantity is null) as nulls, min(l_discount) as lo, max(l_discount) as hi from lineitem),
c as (select n >= 1 as ok from s union all select nulls = 0 from s union all select nulls = 0 from s union all select lo >= 0.0 from s union all select hi <= 0.05 from s union all select true)
select count(*) as checks, count(*) filter (not ok) as failed, case when count(*) filter (not ok) = 0 then 'PASS' else 'FAIL' end as result from c""")
def dq_overall(spark, sf_dir):
    return quality.overall(quality.run_checks(load(spark, sf_dir, "lineitem"), 1, ("l_quantity",), ranges={"l_discount": (0.0, 0.05)}))


@query("""
select count(*) as n_rows, 4 as n_columns, cast((count(quality) < count(*))::int + (count(toxic) < count(*))::int + (count(lang) < count(*))::int + (count(d.doc_id) < count(*))::int as int) as columns_with_nulls,
  count(*) - count(distinct d.doc_id) as duplicate_keys from documents d left join labels l on d.doc_id = l.doc_id""")
def dq_profile(spark, sf_dir):
    joined = load(spark, sf_dir, "documents").select("doc_id", "lang").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.profile(joined.select("doc_id", "lang", "quality", "toxic"), ["doc_id"])


@query("""
select 'orders_customer' as table_name, (select count(*) from orders) as source_rows, (select count(*) from orders left join customer on o_custkey = c_custkey) as target_rows, true as matches
union all select 'lineitem_keys', (select count(*) from lineitem), (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)),
  (select count(*) from lineitem) = (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))""")
def dq_reconcile(spark, sf_dir):
    orders, customer, lines = (load(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    return quality.reconcile_counts({
        "orders_customer": (orders.select("o_custkey"), orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")),
        "lineitem_keys": (lines.select("l_orderkey"), lines.select("l_orderkey", "l_linenumber").distinct()),
    })
