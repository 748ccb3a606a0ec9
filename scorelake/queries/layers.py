"""Bronze and silver loads, written to the shared folder and read again."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..sources import control, ingest, layers
from ..sources.tables import TableSpec, load
from . import query
from .history import CUT, EVENT_HASH, NOW, events, ntz
from .folders import shared_folder

SPEC = TableSpec("EVENTS", "events", "incremental", "scd2", ("user_id",), ("ts",), "ts")


def _bronze(spark, sf_dir):
    """Three loads: up to a cut, everything, and the same again, which finds nothing."""
    path = f"{shared_folder(spark)}/bronze"
    source = events(spark, sf_dir)
    for number, rows in enumerate((source.where(F.col("ts") < ntz(CUT)), source, source)):
        layers.load_bronze(rows, path, SPEC, "mart", f"run-{number}", ntz(NOW))
    return spark.read.parquet(path)


@query(f"""
select case when ts < timestamp '{CUT}' then 'historical' else 'incremental' end as _load_type, case when ts < timestamp '{CUT}' then 'run-0' else 'run-1' end as _ingestion_id, count(*) as n, min(event_id) as low, max(event_id) as high
from events group by all""")
def bronze_loads(spark, sf_dir):
    return _bronze(spark, sf_dir).groupBy("_load_type", "_ingestion_id").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))


@query(f"""
select case when ts < timestamp '{CUT}' then 'run-0' else 'run-1' end as _ingestion_id, case when ts < timestamp '{CUT}' then 'historical' else 'incremental' end as _load_type, count(*) as n, min(event_id) as low, max(event_id) as high,
  (select max(ts) from events) as mark, 0::bigint as rows_processed, 'run-3' as last_run from events group by all""")
def bronze_marked(spark, sf_dir):
    """Loads by the control table's mark: up to a cut, the rest, a batch that fails its checks, and one that finds nothing new."""
    folder = shared_folder(spark)
    source = events(spark, sf_dir)
    later = source.withColumns({"ts": F.col("ts") + F.expr("interval 100 days"), "user_id": F.lit(None).cast("long")})
    for number, rows in enumerate((source.where(F.col("ts") < ntz(CUT)), source, later, source)):
        layers.load_bronze_marked(rows, f"{folder}/bronze", f"{folder}/control", SPEC, "mart", f"run-{number}", ntz(NOW), {"not_null": ("user_id",)})
    state = control.read(spark, f"{folder}/control").select(F.col("last_processed_watermark").alias("mark"), "rows_processed", F.col("run_id").alias("last_run"))
    loads = layers.read_bronze(spark, f"{folder}/bronze").groupBy("_ingestion_id", "_load_type").agg(F.count("*").alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))
    return loads.crossJoin(F.broadcast(state))  # one row, the only table's


@query("select event_type as table_name, max(ts) as last_processed_watermark, count(*) as rows_processed from events group by 1")
def control_commits(spark, sf_dir):
    """A run for each event type, all at once; each commits its row under a version of its own."""
    path = f"{shared_folder(spark)}/control"
    marks = events(spark, sf_dir).groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("mark"), F.count("*").alias("n")).collect()  # the inventory
    run = lambda r: spark.createDataFrame([(r["table_name"], "bronze", r["mark"], "SUCCESS", r["mark"], r["n"], "run-1")], ingest.CONTROL)
    with ThreadPoolExecutor(len(marks) or 1) as pool:
        list(pool.map(lambda r: control.commit(spark, path, run(r), attempts=50, base_delay=0.02), marks))
    return control.read(spark, path).select("table_name", "last_processed_watermark", "rows_processed")


SILVER_HASH = EVENT_HASH.replace("concat_ws(chr(31), ", "concat_ws(chr(31), cast(event_id as varchar), ")
SILVER_SQL = f"""
with e as (select *, {SILVER_HASH} as h from events),
b as (select * from (select *, row_number() over (partition by user_id order by ts desc) as n from e where ts < timestamp '{CUT}') where n = 1),
c as (select * from (select *, row_number() over (partition by user_id order by ts desc) as n from e where ts >= timestamp '{CUT}') where n = 1),
out as (
  select b.user_id, b.event_id, b.h as _row_hash, b.ts as _effective_from, c.ts as _effective_to, c.ts is null as _is_current from b left join c on b.user_id = c.user_id
  union all select user_id, event_id, h, ts, null, true from c)
"""


def _silver(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    folder, state = f"{shared_folder(spark)}/silver", None
    for run in ("run-0", "run-1"):
        path = layers.write_silver(layers.silver_state(bronze.where(F.col("_ingestion_id") == run), state, SPEC, "ts", ntz(NOW)), folder)
        state = spark.read.parquet(path)
    return bronze, state


@query(SILVER_SQL + "select user_id, event_id, _row_hash, _effective_from, _effective_to, _is_current from out")
def silver_loads(spark, sf_dir):
    return _silver(spark, sf_dir)[1].select("user_id", "event_id", "_row_hash", "_effective_from", "_effective_to", "_is_current")


@query(SILVER_SQL + f"select (select count(*) from events) as bronze_rows, (select count(*) from out) as silver_rows, '' as missing")
def silver_validation(spark, sf_dir):
    return layers.validate_silver(*_silver(spark, sf_dir))


@query(f"""
select c_custkey, c_name, true as _is_current, timestamp '{NOW}' as _effective_from from customer
union all select c_custkey, c_name, null, null from customer where c_mktsegment = 'BUILDING'""")
def silver_strategies(spark, sf_dir):
    """A historical load, then an append-only one onto it."""
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    full = layers.silver_state(customer, None, TableSpec("CUSTOMER", "customer"), None, ntz(NOW))
    more = layers.silver_state(customer.where("c_mktsegment = 'BUILDING'"), full, TableSpec("CUSTOMER", "customer", "incremental", "append"), None, ntz(NOW))
    return more.select("c_custkey", "c_name", "_is_current", "_effective_from")


@query("select count(*) as rows, '' as missing from events")
def bronze_check(spark, sf_dir):
    return ingest.bronze_check(_bronze(spark, sf_dir))


@query("select event_type as table_name, max(ts) as mark from events group by 1 union all select 'no_such', null")
def control_marks(spark, sf_dir):
    """The last good mark of every table of the control table, and of one that isn't there."""
    marks = events(spark, sf_dir).groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("last_processed_watermark"), F.count("*").alias("rows_processed"))
    runs = marks.select("table_name", F.lit("bronze").alias("layer"), "last_processed_watermark", F.lit("SUCCESS").alias("last_run_status"), ntz(NOW).alias("last_run_timestamp"), "rows_processed", F.lit("run-1").alias("run_id"))
    control = ingest.next_control(ingest.empty_control(spark), runs)
    wanted = control.select("table_name").union(spark.createDataFrame([("no_such",)], "table_name string"))
    return ingest.last_watermarks(control, wanted, "bronze")
