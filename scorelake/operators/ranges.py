"""Running sums in two levels, so that no task orders a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .joins import join_keyed

ROWS_PER_RANGE = 1_000_000


def running_sums(rows: DataFrame, by: list[str], order: list[str], columns: list[str], at_most: int | None = None, rows_per_range: int | None = None) -> DataFrame:
    """``rows`` with ``_upto_<c>``, the sum of each column within ``by`` up to the row in ``order``, and ``_all_<c>``, the group's.

    ``order`` must be total within a group, and ``rows`` cheap to read again (a written table).  Tables
    of up to ``rows_per_range`` rows (``at_most`` can tell that without a count) take one window a
    group.  Larger ones are dealt to ranges of about that many rows in order of (by, order), and
    written so; the totals of ranges give each range its start, a window inside a range the rest.
    """
    limit = rows_per_range or ROWS_PER_RANGE
    number = at_most if at_most is not None and at_most <= limit else rows.count()
    group = by or [F.lit(0)]
    if number <= limit:
        upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumns({f"_upto_{c}": F.sum(c).over(upto) for c in columns} | {f"_all_{c}": F.sum(c).over(Window.partitionBy(*group)) for c in columns})
    dealt = written(rows.repartitionByRange(-(-number // limit), *by, *order).withColumn("_range", F.spark_partition_id()))
    totals = dealt.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    # A group has a row a range here.
    along = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *by, "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(along), F.lit(0)).alias(f"_before_{c}") for c in columns], *[F.sum(f"_sum_{c}").over(Window.partitionBy(*group)).alias(f"_all_{c}") for c in columns]
    )
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = join_keyed(dealt, before, [*by, "_range"])
    return joined.withColumns({f"_upto_{c}": F.col(f"_before_{c}") + F.sum(c).over(inside) for c in columns}).drop("_range", *[f"_before_{c}" for c in columns])
