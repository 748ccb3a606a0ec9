"""Lexical search against scoring every document, and the bounds against what they bound."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from scorelake.llm import search

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in WORDS.findall(text or "")]


def brute(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            score = sum(weight[t] * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            scores.append((-score, d is None, d or 0, d))
        best = [x for x in sorted(scores) if x[0] < 0][:k]
        out += [(item, i, x[3], -x[0]) for i, x in enumerate(best, 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, parts=4, **options):
    d = spark.createDataFrame([(i, t, "clash", 7) for i, t in docs], "doc_id long, text string, rank string, digest int").repartition(parts)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search.lexical_search(d, q, **options).collect()), key=repr)


def corpus(seed, n=400):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "中文", "the"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda size: " ".join(rnd.choices(vocabulary, weights, k=size))
    docs = [(i, text(rnd.choice([1, 5, 30, 80]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " \x00 -- "), (None, docs[3][1]), (5, docs[5][1]), (5, docs[6][1]), (n + 3, "W1 w1\tW1" * 2000), (n + 4, "w2")]
    docs += [(n + 10 + i, docs[7][1]) for i in range(50)]  # ties by id
    items = [(i, text(rnd.choice([1, 2, 8, 30]))) for i in range(12)] + [(50, None), (51, ""), (52, "unseen"), (None, "w1 W3"), (0, "w1 w1 w9"), (0, "w1 w1 w9"), (53, "the The THE 中文")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"k": 3, "block_docs": 16}, {"block_docs": 1, "query_terms": 20}])
def test_equals_scoring_every_document(spark, options):
    docs, items = corpus(1)
    assert found(spark, docs, items, **options) == brute(docs, items, options.get("k", 20))


def test_empty_tables(spark):
    docs, items = corpus(2, 20)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None)], items) == []


def test_a_third_of_all_documents_alike(spark):
    docs, items = corpus(3, 300)
    docs += [(10_000 + i, "w1 w2 w3 w40") for i in range(180)]
    assert found(spark, docs, items, block_docs=32) == brute(docs, items, 20)


def blocks_of(spark, docs, items, block_docs):
    """The index's blocks, and the batch with its weights."""
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    queries = search.item_terms(spark.createDataFrame(items, "item_id long, text string"))
    _, batch = next(search._batches(queries, 10_000))
    blocks = search.build_blocks(d, batch.vocabulary, block_docs)
    weighted = search.weigh(batch, blocks)
    rows = [{n: np.array(v) for n, v in r.asDict().items() if isinstance(v, list)} for r in search.build_index(blocks, weighted).collect()]
    return [search.Block(r, weighted) for r in rows], weighted


def test_pair_bounds_hold_and_are_tighter_than_single_maxima(spark):
    docs, items = corpus(4)
    blocks, queries = blocks_of(spark, docs, items, 64)
    tighter = 0
    for block in blocks:
        for item in range(len(queries.terms)):
            place, counts, upto, reached = block.bounds(item)
            scores = np.zeros((len(place) + 1, len(block.ids)), np.int64)
            for i, p in enumerate(place):
                held, impacts = block.list_of(p)
                scores[i + 1] = scores[i]
                scores[i + 1][held] += counts[i] * impacts
            assert (scores.max(1) <= upto).all()
            assert reached <= scores[-1].max(initial=0)
            assert upto[-1] <= int((counts * block.tops[place]).sum())
            tighter += upto[-1] < int((counts * block.tops[place]).sum())
    assert tighter > 20


def test_joint_maxima_are_exact(spark):
    docs, items = corpus(5, 200)
    blocks, queries = blocks_of(spark, docs, items, 50)
    size = len(queries.weights)
    for block in blocks:
        held = {int(t): dict(zip(*map(np.ndarray.tolist, block.list_of(i)))) for i, t in enumerate(block.terms)}
        want = {}
        for number, p in enumerate(queries.pairs.tolist()):
            a, b = held.get(p // size, {}), held.get(p % size, {})
            if both := set(a) & set(b):
                want[number] = max(a[d] + b[d] for d in both)
        assert dict(zip(block.pairs.tolist(), block.joints.tolist())) == want
