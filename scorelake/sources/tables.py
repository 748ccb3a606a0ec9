"""Table reads, table specs and the current view of versioned tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], partition_column: str | None = None, lower: str | None = None, upper: str | None = None, partitions: int = 1
) -> DataFrame:
    """Full table scan of a database; parallel over ranges of ``partition_column``.

    Filters on the result are pushed to the database by the source, so there is no query variant.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column:
        reader = reader.options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return reader.load()


def slice_predicates(column: str, cuts: list, heavy: list, nulls: bool = True) -> list[str]:
    """WHERE clauses that give every row to exactly one slice: between cuts, each heavy value alone, nulls alone."""
    at = [_sql_value(c) for c in cuts]
    alone = [_sql_value(v) for v in heavy]
    ranges = [(f"{column} >= {low}" if low else "", f"{column} < {high}" if high else "") for low, high in zip([None, *at], [*at, None])]
    others = [f"{column} <> {v}" for v in alone]
    clauses = [" AND ".join([*(p for p in pair if p), *others]) or f"{column} IS NOT NULL" for pair in ranges]
    return [*clauses, *[f"{column} = {v}" for v in alone], *([f"{column} IS NULL"] if nulls else [])]


def _sql_value(value) -> str:
    """A literal that every driver takes: times as JDBC escapes."""
    if isinstance(value, datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    return repr(float(value)) if isinstance(value, float) else str(value)


def read_jdbc_slices(spark: SparkSession, url: str, table: str, properties: dict[str, str], column: str, slices: int, sample_where: str | None = None) -> DataFrame:
    """A database table in about equal slices of ``column`` (number, date or time), a connection and a partition each.

    Equal ranges of a skewed column aren't equal slices, so cuts are quantiles of the column, which
    the database sends alone, or of the part of it that ``sample_where`` keeps (a clause by which the
    database samples).  A value that fills a slice gets one of its own, and so do nulls.  Filters on
    the result are pushed to the database beside the slice's own.
    """
    source = f"(SELECT {column} AS slice_key FROM {table}{f' WHERE {sample_where}' if sample_where else ''}) slices"
    keys = read_jdbc(spark, url, source, properties).select(F.col("slice_key").alias("k")).where("k is not null")
    steps = [i / slices for i in range(1, slices)]
    found = keys.agg(F.percentile_approx("k", steps, 100 * slices).alias("cuts")).first()["cuts"] if steps else []
    found = found or []
    # A value that is several quantiles holds more than a slice.
    heavy = sorted({c for c in found if found.count(c) > 1})
    cuts = sorted(set(found) - set(heavy))
    return spark.read.jdbc(url, table, predicates=slice_predicates(column, cuts, heavy), properties=properties)


@dataclass(frozen=True)
class TableSpec:
    """One row of the table inventory; keys and order columns may be several, comma-separated."""

    source_table: str
    target_table: str
    load_type: str = "historical"
    strategy: str = ""
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    watermark: str | None = None
    active: bool = True
    extra: dict[str, str] = field(default_factory=dict)

    def validate(self, columns: list[str]) -> None:
        """SCD2 needs keys and order columns, and they must be there under their cleaned names."""
        if self.strategy == "scd2" and not (self.keys and self.order_by):
            raise ValueError(f"{self.source_table}: SCD2 needs a key and an order column")
        missing = [c for c in (*self.keys, *self.order_by) if c not in columns]
        if missing:
            raise ValueError(f"{self.source_table}: no column {', '.join(missing)}")


def _list(text: str | None) -> tuple[str, ...]:
    return tuple(x.strip().lower() for x in (text or "").split(",") if x.strip())


def read_specs(spark: SparkSession, path: str) -> list[TableSpec]:
    """The inventory CSV as specs (configuration: a row a table)."""
    rows = [r.asDict() for r in spark.read.csv(path, header=True).collect()]
    known = {"source_table", "target_table", "load_type", "strategy", "primary_key", "order_by", "watermark_column", "is_active"}
    return [
        TableSpec(
            r["source_table"], r.get("target_table") or r["source_table"].lower(), (r.get("load_type") or "historical").lower(), (r.get("strategy") or "").lower(),
            _list(r.get("primary_key")), _list(r.get("order_by")), r.get("watermark_column") or None,
            (r.get("is_active") or "true").strip().lower() in ("true", "1", "y", "yes"), {k: v for k, v in r.items() if k not in known and v is not None},
        )
        for r in rows
    ]


def find_spec(specs: list[TableSpec], name: str) -> TableSpec:
    """First active spec whose source or target has that name, in any case."""
    for spec in specs:
        if spec.active and name.lower() in (spec.source_table.lower(), spec.target_table.lower()):
            return spec
    raise LookupError(f"no active table {name}")


def current_view(df: DataFrame) -> DataFrame:
    """Current rows without the columns that start with ``_``; tables without versions pass whole."""
    if "_is_current" in df.columns:
        df = df.where(F.col("_is_current"))
    return df.drop(*[c for c in df.columns if c.startswith("_")])
