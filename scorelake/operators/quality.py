"""Data-quality checks, each set of them one pass over the data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

RESULT = ["check_name", "column_name", "passed", "value"]


def long_form(row: DataFrame, checks: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """One wide row of aggregates as rows (check_name, column_name, passed, value)."""
    items = [F.struct(F.lit(c).alias("check_name"), F.lit(n).alias("column_name"), F.coalesce(p, F.lit(True)).alias("passed"), v.cast("double").alias("value")) for c, n, p, v in checks]
    return row.select(F.inline(F.array(*items)))


def run_checks(
    df: DataFrame, min_rows: int = 1, not_null: tuple[str, ...] = (), required: tuple[str, ...] = (), keys: tuple[str, ...] = (),
    ranges: dict[str, tuple[float, float]] | None = None, target: tuple[str, str, str] | None = None, bad_share: tuple[float, float] = (1.0, 50.0),
) -> DataFrame:
    """The suite: row count, required columns, null counts, key uniqueness, value ranges, class balance.

    Columns that aren't there are skipped by the null check (``required`` is what reports them);
    any null fails; an all-null column passes its range; ``target`` is (column, bad, good).  Null
    percentages, averages and the good:bad ratio come as rows of their own.
    """
    aggregates, checks = _suite(df.columns, min_rows, not_null, required, keys, ranges or {}, target, bad_share)
    return long_form(df.agg(*aggregates), checks)


def checked_write(
    df: DataFrame, write: Callable[[DataFrame], None], min_rows: int = 1, not_null: tuple[str, ...] = (), required: tuple[str, ...] = (),
    ranges: dict[str, tuple[float, float]] | None = None, target: tuple[str, str, str] | None = None, bad_share: tuple[float, float] = (1.0, 50.0), more: dict[str, Column] | None = None,
) -> tuple[DataFrame, dict]:
    """Write ``df`` by ``write``, and the suite of what was written, from the pass that writes it.

    The aggregates (and those of ``more``) are observed as the last step before the write, in the
    tasks whose output is committed, so they are of the very rows in the files, also if the source
    changes meanwhile or tasks run again.  (checks, values of all aggregates).  Key uniqueness needs a
    shuffle and isn't among the checks.
    """
    aggregates, checks = _suite(df.columns, min_rows, not_null, required, (), ranges or {}, target, bad_share)
    aggregates += [c.alias(n) for n, c in (more or {}).items()]
    seen = Observation()
    write(df.observe(seen, *aggregates))
    kinds = StructType([StructField(f.name, f.dataType) for f in df.agg(*aggregates).schema])  # analysed, never run
    found = seen.get
    values = {n: found.get(n) for n in kinds.names}
    return long_form(df.sparkSession.createDataFrame([tuple(values.values())], kinds), checks), values


def _suite(
    columns: list[str], min_rows: int, not_null: tuple[str, ...], required: tuple[str, ...], keys: tuple[str, ...], ranges: dict[str, tuple[float, float]], target: tuple[str, str, str] | None, bad_share: tuple[float, float]
) -> tuple[list[Column], list[tuple[str, str, Column, Column]]]:
    """The aggregates of a suite, and its checks over their names."""
    not_null = tuple(c for c in not_null if c in columns)
    aggregates = [F.count("*").alias("rows")]
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in not_null]
    for c in ranges:
        aggregates += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.avg(c).alias(f"avg_{c}")]
    if keys:
        aggregates.append(F.count_distinct(F.struct(*keys)).alias("distinct_keys"))
    if target:
        aggregates += [F.count_if(F.col(target[0]) == target[1]).alias("bad"), F.count_if(F.col(target[0]) == target[2]).alias("good")]
    checks = [("row_count", "*", F.col("rows") >= min_rows, F.col("rows"))]
    checks += [("required", c, F.lit(c in columns), F.lit(float(c in columns))) for c in required]
    for c in not_null:
        nulls = F.col(f"nulls_{c}")
        checks += [("not_null", c, nulls == 0, nulls), ("null_pct", c, nulls == 0, nulls * 100.0 / F.nullif(F.col("rows"), F.lit(0)))]
    if keys:
        duplicates = F.col("rows") - F.col("distinct_keys")
        checks.append(("unique", ",".join(keys), duplicates == 0, duplicates))
    for c, (low, high) in ranges.items():
        checks += [("range_min", c, F.col(f"min_{c}") >= low, F.col(f"min_{c}")), ("range_max", c, F.col(f"max_{c}") <= high, F.col(f"max_{c}"))]
        checks.append(("range_avg", c, F.lit(True), F.col(f"avg_{c}")))
    if target:
        share = F.col("bad") * 100.0 / F.nullif(F.col("rows"), F.lit(0))
        checks.append(("bad_share", target[0], share.between(*bad_share), share))
        checks.append(("good_bad_ratio", target[0], F.lit(True), F.col("good") / F.nullif(F.col("bad"), F.lit(0))))
    return aggregates, checks


def overall(checks: DataFrame) -> DataFrame:
    """PASS or FAIL of a suite, with the number of failures."""
    failed = F.count_if(~F.col("passed"))
    return checks.agg(F.count("*").alias("checks"), failed.alias("failed"), F.when(failed == 0, "PASS").otherwise("FAIL").alias("result"))


def profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, columns, columns with nulls (without ``_`` ones) and surplus rows per key, in one pass."""
    plain = [c for c in df.columns if not c.startswith("_")]
    row = df.agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*keys)).alias("_keys"), *[F.max(F.col(c).isNull().cast("int")).alias(f"_null_{c}") for c in plain])
    with_nulls = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"_null_{c}"), F.lit(0)) for c in plain], F.lit(0))
    return row.select("n_rows", F.lit(len(df.columns)).alias("n_columns"), with_nulls.alias("columns_with_nulls"), (F.col("n_rows") - F.col("_keys")).alias("duplicate_keys"))


def reconcile_counts(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per name: rows of source and target, and whether they agree."""
    parts = []
    for name, (source, target) in tables.items():
        both = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(target.select(F.lit(0), F.lit(1)))
        parts.append(both.agg(F.sum("s").alias("source_rows"), F.sum("t").alias("target_rows")).select(F.lit(name).alias("table_name"), "source_rows", "target_rows"))
    return reduce(DataFrame.unionByName, parts).withColumn("matches", F.col("source_rows") == F.col("target_rows"))
