"""The filter audit against walking every order over every document."""

import random
import re
from fractions import Fraction
from itertools import permutations

import pytest

from scorelake.llm import filteraudit
from scorelake.llm.filteraudit import FILTERS, audit_documents, shapley_weights

DOCS = "doc_id long, text string, lang string, n long, part string"
LABELS = "doc_id long, quality int, toxic int"


def failing(rows):
    """The filters that each (doc_id, text, lang) fails, word by word."""
    out = []
    for doc_id, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = [d for d, other, _ in rows if (other or "") == t and d is not None and doc_id is not None and d < doc_id]
        found = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), bool(smaller)]
        out.append("".join(f for f, x in zip(FILTERS, found) if x))
    return out


def brute(rows, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    fails, want = failing(rows), {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        total = dict.fromkeys(FILTERS, 0)
        for order in map("".join, permutations(FILTERS)):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                total[x] += len(gone)
                earlier = sum(1 for d, f in own if x in f and set(f) & set(order[: step - 1]))
                want[part, order, step] = [len(left), len(gone), earlier, sum(f == x for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in want.items():
            if p == part:
                row.append(total[order[step - 1]])
    return want


def found(spark, rows, labels, parts=3):
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], DOCS).repartition(parts)
    got = audit_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got}
    assert len(out) == len(got)
    return out


def odd_rows():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdEFé") for _ in range(rnd.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rnd.choice([3, 99, 100, 130]))) for _ in range(12)]
    texts += ["w%d " % 1 * 120, " ".join(f"w{i}" for i in range(100)), "\t".join(f"w{i}" for i in range(101)) + " #", "A" * 11 + "b" * 99, "A" * 10 + "b" * 90, "", None, " \n\x0b", "x" * 300_000, "no break space " * 50, "a\x1cb\x85c " * 40]
    rows = [(i, t, rnd.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    rows += [(100 + i, rnd.choice(texts), rnd.choice(["en", None])) for i in range(40)] + [(None, texts[0], "en"), (None, None, "fr"), (3, texts[3], "en"), (3, texts[3], "en"), (3, texts[4], "de")]
    return rows


def test_equals_walking_every_order(spark):
    rows = odd_rows()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(3, 1, 0), (3, 0, 1), (5, None, None), (None, 1, 1), (999, 1, 1)]
    labels = [(a, b, None if c is None else int(c)) for a, b, c in labels]
    want = brute(rows, labels)
    assert found(spark, rows, labels) == want
    assert found(spark, rows[::-1], labels, 1) == want


def test_a_third_of_all_rows_alike(spark):
    rows = [(i, "same text", "en") for i in range(200)] + [(1000 + i, f"text {i}", "en") for i in range(400)]
    got = found(spark, rows, [])
    assert got["en", "EABCD", 1][1] == 199 and got == brute(rows, [])


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_few_rows(spark, rows):
    assert found(spark, rows, []) == brute(rows, [])


@pytest.mark.parametrize("filters", [1, 2, 3, 5])
def test_constrained_least_squares_is_shapley(filters):
    rnd = random.Random(filters)
    v = [0, *(rnd.randint(0, 99) for _ in range((1 << filters) - 1))]
    orders = list(permutations(range(filters)))
    for i, factors in enumerate(shapley_weights(filters)):
        gains = [v[sum(1 << j for j in o[: o.index(i) + 1])] - v[sum(1 << j for j in o[: o.index(i)])] for o in orders]
        assert sum(f * x for f, x in zip(factors, v)) == Fraction(sum(gains), len(orders))


def test_solve_swaps_rows():
    one = Fraction(1)
    assert filteraudit.solve([[0 * one, one], [2 * one, one]], [[3 * one], [5 * one]]) == [[one], [3 * one]]
