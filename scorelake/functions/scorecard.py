"""Scorecard scaling and grading as column functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 600 points at odds of 50 to 1, 20 points double the odds.
TARGET_SCORE, TARGET_ODDS, POINTS_TO_DOUBLE = 600, 50, 20
GOOD_THRESHOLD = 0.95
# Grades from the best, each with its lowest score.
GRADES = [("A1", 750), ("A2", 700), ("B1", 650), ("B2", 600), ("C1", 550), ("C2", 500)]

FACTOR = POINTS_TO_DOUBLE / math.log(2)
OFFSET = TARGET_SCORE - FACTOR * math.log(TARGET_ODDS)


def points(p_bad: Column) -> Column:
    """Half-even rounded score in 0..999; odds of 500 where nothing is bad, 0 where nothing is good."""
    odds = F.when(p_bad > 0, (1 - p_bad) / F.greatest(p_bad, F.lit(1e-10))).when(p_bad <= 0, F.lit(TARGET_ODDS * 10.0))
    score = F.bround(F.lit(OFFSET) + F.lit(FACTOR) * F.ln(odds))
    # greatest() skips nulls, so the null logarithm of zero odds becomes 0.
    return F.when(p_bad.isNotNull(), F.least(F.greatest(score, F.lit(0.0)), F.lit(999.0))).cast("int")


def grade(score: Column) -> Column:
    out = F.when(score >= GRADES[0][1], GRADES[0][0])
    for name, least in GRADES[1:]:
        out = out.when(score >= least, name)
    return out.otherwise("D")


def inferred_flag(p_good: Column, threshold: float = GOOD_THRESHOLD) -> Column:
    return F.when(p_good >= threshold, "Good").otherwise("Bad")


def observed_label(sample: Column, target: Column) -> Column:
    """The outcome of funded loans that have one; null where it isn't known."""
    return F.when((sample == "Funded") & target.isin("Good", "Bad"), target)


def score_columns(df: DataFrame, p_bad: str) -> DataFrame:
    """pd_estimate, final_p_good, goodbadflag_inferred, credit_score and risk_grade."""
    df = df.withColumns({"pd_estimate": F.col(p_bad), "final_p_good": 1 - F.col(p_bad), "credit_score": points(F.col(p_bad))})
    return df.withColumns({"goodbadflag_inferred": inferred_flag(F.col("final_p_good")), "risk_grade": grade(F.col("credit_score"))})


def lineage(df: DataFrame, at: Column, model: str, uri: str, version: int) -> DataFrame:
    return df.withColumns({"_scored_at": at, "_model_name": F.lit(model), "_model_uri": F.lit(uri), "_model_version": F.lit(version)})
