"""The application star mart: fact and dimensions, bridge and facility, performance window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lending
from ..operators import quality
from ..sources import sinks


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Left joins in order; every dimension must have one row a key, so the fact's rows are kept."""
    for dim, keys in dims:
        fact = fact.join(dim, keys, "left")
    return fact


def facilities(fact: DataFrame, bridge: DataFrame, facility: DataFrame, performance: DataFrame, application_key: str, facility_key: str) -> DataFrame:
    """Approved rows get their facility and its performance, declined ones nulls; several bridge rows fan out.

    The bridge's rows meet the facility first: by the facility's key, all rows of the fact without one would go to one task.
    """
    leg = bridge.join(facility, facility_key, "left").join(performance, facility_key, "left")
    return fact.join(leg, application_key, "left")


def performance_window(rows: DataFrame, key: str, months: str, arrears: str, hardship: str, snapshot: str, horizon: int = 24) -> DataFrame:
    """Per facility, over the first ``horizon`` months: worst arrears, hardship ever, rows, last snapshot."""
    # The names of the result.
    return rows.where(F.col(months) <= horizon).groupBy(key).agg(
        F.max(arrears).alias(f"max_arrears_days_{horizon}mo"), F.max(F.when(F.col(hardship) == "Y", 1).otherwise(0)).alias(f"hardship_ever_{horizon}mo"),
        F.count("*").alias("perf_observations"), F.max(snapshot).alias("last_observed_date"),
    )


def with_flags(joined: DataFrame, decision: str, date: str, horizon: int = 24) -> DataFrame:
    """Joined rows with target_flag, sample_flag and dp3_application."""
    return joined.withColumns({
        "target_flag": lending.target_flag(F.col(decision) == "DECLINED", F.col(f"max_arrears_days_{horizon}mo"), F.col(f"hardship_ever_{horizon}mo")),
        "sample_flag": lending.sample_flag(F.col(decision) == "APPROVED"),
        "dp3_application": lending.month_end(F.col(date)),
    })


def application_mart(fact: DataFrame, dims: list[tuple[DataFrame, list[str]]], performance: DataFrame, key: str, decision: str, date: str, horizon: int = 24) -> DataFrame:
    """The joined mart with its flags; ``key``, which every row has, is the performance's."""
    return with_flags(star_join(fact, dims).join(performance, key, "left"), decision, date, horizon)


def full_mart(
    fact: DataFrame, dims: list[tuple[DataFrame, list[str]]], bridge: DataFrame, facility: DataFrame, performance: DataFrame, application_key: str, facility_key: str, decision: str, date: str, horizon: int = 24
) -> DataFrame:
    """Dimensions, facility and its performance in one row an application; the surrogate facility key goes."""
    joined = facilities(star_join(fact, dims), bridge, facility, performance, application_key, facility_key)
    return with_flags(joined, decision, date, horizon).drop(facility_key)


def write_mart(built: DataFrame, fact: DataFrame, path: str) -> DataFrame:
    """Write the mart and reconcile its grain: rows of the fact, rows written (seen by the write), and whether they agree.

    A dimension with two rows a key, or an application with two bridge rows, shows here as more rows than the fact has.
    """
    _, seen = quality.checked_write(built, lambda df: sinks.overwrite(df, path))
    return fact.agg(F.count("*").alias("source_rows")).withColumn("target_rows", F.lit(seen["rows"])).withColumn("matches", F.col("source_rows") == F.col("target_rows"))
