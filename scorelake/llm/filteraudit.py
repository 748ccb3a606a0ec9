"""How text filters interact: what every coalition and every order of them removes, and each filter's Shapley share.

A document's failed filters are bits of a mask.  Rows are counted by part and mask, and from those
counts comes, for each part, the number of documents that each of the 2**5 coalitions removes.
Everything else is made of these numbers:

* a step of an order removes what the coalition up to it removes beyond the coalition before it;
* a filter's Shapley value is the solution of the least squares that approximate the coalitions'
  removals by a sum over their members, weighted with the Shapley kernel and held to give the whole
  coalition's removals exactly.  The normal equations, bordered by that constraint, are solved in
  rationals.  They depend on the number of filters alone, so they are solved once, for every unit
  vector of removals, and Spark applies the (integer) solution to each part's numbers.

Defined results: a null text is empty (it fails A and, after an equal text, E).  A null ``lang`` is
the part "".  A row fails E if a row of equal text has a smaller id; null ids are neither smaller nor
larger than any.  Repeated rows count each.  A document is good (toxic) if any of its labels says so;
documents without labels, or without an id, are neither.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import materialise

FILTERS = "ABCDE"
#: Characters that separate words, all mapped to the first before splitting.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SIGNS = 100, 80, 10, "[#$%&*|]"


def text_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and ``bits``: 1, 2, 4 and 8 for the filters A to D, which look at one text."""
    text, words = F.col("text"), F.col("words")
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    alike = F.translate(text, SPACES, " " * len(SPACES))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split(alike, " "), lambda w: w != ""))
    fails = [F.size(words) < MIN_WORDS, 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words), 100 * upper > MAX_UPPER * F.length(text), text.rlike(SIGNS)]
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", F.unhex(F.sha2(text, 256)).alias("digest"), bits.alias("bits"))


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (bit i for filter i of FILTERS) and n, the number of rows that are alike in id, text and part.

    Texts are shuffled as digests, each row once.  The first id of each text comes from an aggregate
    and is joined by text and id, so the copies of a common text are spread by their ids.
    """
    slim = text_failures(docs).groupBy("doc_id", "part", "digest", "bits").agg(F.count("*").alias("n"))
    slim = materialise(slim, "audit-failures")  # used twice
    first = slim.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("leads", F.lit(True))
    later = F.when(F.col("leads").isNull() & F.col("doc_id").isNotNull(), 16).otherwise(0)
    return slim.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("bits") + later).alias("mask"), "n")


def removals(rows: DataFrame, filters: int) -> DataFrame:
    """One row a part: ``removed``, for each coalition (its bits are the index) the n, good and toxic that it removes; ``total``: all n.

    ``rows``: part, mask, n, good, toxic.
    """
    counts = ("n", "good", "toxic")
    tabulated = rows.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])
    each = tabulated.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    each = each.groupBy("part", "coalition").agg(F.sum("n").alias("total"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in counts])
    # A part has a row for each coalition, so the list's length is fixed.
    return each.groupBy("part").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("coalition", *counts))).alias("removed"))


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with matrix X = right, by elimination in rationals."""
    size = len(matrix)
    rows = [[*a, *b] for a, b in zip(matrix, right, strict=True)]
    for i in range(size):
        pivot = next(r for r in range(i, size) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(size):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i], strict=True)]
    return [row[size:] for row in rows]


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """For each filter, the factor of each coalition's removals in the filter's Shapley value.

    Least squares over the coalitions S that are neither empty nor whole, each weighted with
    (m - 1) / (C(m, |S|) |S| (m - |S|)), under the constraint that the values sum to the whole
    coalition's removals.
    """
    whole = (1 << filters) - 1
    if filters == 1:
        return [[Fraction(0), Fraction(1)]]
    inner = range(1, whole)
    size = {s: s.bit_count() for s in inner}
    weight = {s: Fraction(filters - 1, comb(filters, size[s]) * size[s] * (filters - size[s])) for s in inner}
    # Normal equations of the squares, bordered by the constraint and its multiplier.
    matrix = [[sum((weight[s] for s in inner if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(filters)] + [Fraction(1)] for i in range(filters)]
    matrix.append([Fraction(1)] * filters + [Fraction(0)])
    # One right-hand side a coalition: its removals are one, all others' none.
    right = [[weight[s] if s in weight and s >> i & 1 else Fraction(0) for s in range(whole + 1)] for i in range(filters)]
    right.append([Fraction(int(s == whole)) for s in range(whole + 1)])
    return solve(matrix, right)[:filters]


def audit(rows: DataFrame, names: str = FILTERS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for all orders.

    ``rows``: part, mask, and the numbers of documents ``n``, ``good`` and ``toxic``.
    """
    filters, whole = len(names), (1 << len(names)) - 1
    # A sum over all orders is the Shapley value times their number: whole factors for whole removals.
    factors = [[int(f * factorial(filters)) for f in own] for own in shapley_weights(filters)]
    # A fixed table, whatever the input: order, step, the coalitions before and after it, its filter alone, all others, and its factors.
    steps = []
    for order in permutations(range(filters)):
        sets = [sum(1 << i for i in order[:k]) for k in range(filters + 1)]
        steps += [("".join(names[i] for i in order), k + 1, sets[k], sets[k + 1], 1 << own, whole ^ 1 << own, factors[own]) for k, own in enumerate(order)]
    orders = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, after int, alone int, others int, factors array<long>")
    parts = removals(rows, filters).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(filters))))
    by = lambda count, coalition: F.col("removed")[coalition][count]
    gained = lambda count: by(count, F.col("after")) - by(count, F.col("before"))
    shares = F.zip_with("factors", "removed", lambda factor, coalition: factor * coalition["n"])
    return parts.join(F.broadcast(orders), "step").select(
        "part", "filter_order", "step",
        (F.col("total") - by("n", F.col("after"))).alias("kept"),
        gained("n").alias("removed"),
        (by("n", F.col("alone")) - gained("n")).alias("redundant"),
        (by("n", F.lit(whole)) - by("n", F.col("others"))).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("long"), lambda total, x: total + x).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the filters A to E over documents and their labels (doc_id, quality, toxic)."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # Of the labels only marked documents matter.
    marked = failure_masks(docs).join(marks.where("good or toxic"), "doc_id", "left")
    n = F.col("n")
    rows = marked.select("part", "mask", "n", F.when(F.col("good"), n).otherwise(0).alias("good"), F.when(F.col("toxic"), n).otherwise(0).alias("toxic"))
    return audit(rows)
