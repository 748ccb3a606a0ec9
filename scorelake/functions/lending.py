"""Column functions of loan performance and origination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def target_flag(declined: Column, max_arrears: Column, hardship_ever: Column) -> Column:
    """First match wins; without performance the loan isn't funded."""
    return (
        F.when(declined, "Rejected")
        .when((max_arrears >= 90) | (hardship_ever == 1), "Bad")
        .when(max_arrears == 0, "Good")
        .when(max_arrears >= 1, "Indeterminate")
        .otherwise("NotFunded")
    )


def sample_flag(approved: Column) -> Column:
    return F.when(approved, "Funded").otherwise("NotFunded")


def month_end(date: Column) -> Column:
    return F.last_day(F.to_date(date))


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Calendar months from one date's month to another's."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def days_past_due_bucket(days: Column) -> Column:
    return F.when(days <= 0, "0").when(days <= 30, "1-30").when(days <= 60, "31-60").when(days < 90, "61-89").otherwise("90+")


def payment_status(days: Column, hardship: Column) -> Column:
    return F.when(hardship == "Y", "HARDSHIP").when(days == 0, "CURRENT").when(days >= 90, "DEFAULT").otherwise(F.concat(F.lit("ARREARS_"), days.cast("string")))


def level_payment(principal: Column, annual_rate: Column, months: Column) -> Column:
    """Amortising payment a month; without interest the principal is spread evenly."""
    r = annual_rate / 12
    return F.round(F.when(r == 0, principal / months).otherwise(principal * r / (1 - F.pow(1 + r, -months))), 2)


def arrears_amount(payment: Column, days: Column) -> Column:
    return F.round(payment * days / 30, 2)


def running_balance(df: DataFrame, key: list[str], order: list[Column], amount: Column, paydown: Column) -> DataFrame:
    """``balance`` after each row: the amount less all paydowns so far, not below zero."""
    paid = F.sum(paydown).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("balance", F.round(F.greatest(F.lit(0.0), amount - paid), 2))


def calendar(spark: SparkSession, bounds: DataFrame) -> DataFrame:
    """Month ends from ``first`` to ``last`` (a one-row table of dates)."""
    months = bounds.select(F.explode(F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))).alias("month_start"))
    day = F.last_day("month_start")
    return months.select(
        F.date_format(day, "yyyyMM").alias("snapshot_key"), day.alias("snapshot_date"), F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("year_month"), F.when(F.month(day) % 3 == 0, "Y").otherwise("N").alias("is_quarter_end"),
    )
