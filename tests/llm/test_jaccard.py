import random
import re

from pyspark.sql import functions as F

from scorelake.llm import jaccard
from scorelake.llm.components import connected_components


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b c d e f"), (6, "other text here now")]
    doc_id = 10
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 60))]
        for _ in range(rnd.randint(1, 9)):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary).upper()
            rows.append((doc_id, " ".join(words)))
            doc_id += 1
    return rows + rows[-4:]


def test_equals_brute_force(frame):
    for seed, k, num, share in ((1, 3, 90, 0.002), (2, 3, 90, 0.5), (3, 2, 80, 0.1)):
        rows = corpus(seed)
        got = sorted((tuple(r) for r in jaccard.jaccard_components(frame(rows), k, num, 100, share).collect()), key=repr)
        assert got == brute(rows, k, num, 100)


def test_a_column_of_many_unlinked_documents_is_split(frame, monkeypatch):
    rnd = random.Random(9)
    rows = [(i, "all of us say " + " ".join(f"w{rnd.randrange(4)}" for _ in range(rnd.randint(3, 9)))) for i in range(120)]
    rows += [(500 + i, t + " " + rnd.choice(["", "", "tail"])) for i, (_, t) in enumerate(rows[:40])]
    for num, depth in ((60, 4), (40, 2), (60, 1)):
        monkeypatch.setattr(jaccard, "DEPTH", depth)
        got = sorted((tuple(r) for r in jaccard.jaccard_components(frame(rows), 2, num, 100, 0.9, column_pairs=3).collect()), key=repr)
        assert got == brute(rows, 2, num, 100)


def test_very_long_texts(frame):
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(200_000)]
    near = [w if i % 400 else "changed" for i, w in enumerate(words)]
    rows = [(5, " ".join(words)), (6, " ".join(near)), (7, " ".join(words[:100_000])), (8, "short")]
    got = sorted(map(tuple, jaccard.jaccard_components(frame(rows)).collect()))
    assert got == brute(rows, 5, 80, 100) and [c for *_, c in got] == [5, 5, 7, 8]


def test_empty_table_and_clashing_columns(frame):
    assert jaccard.jaccard_components(frame([])).collect() == []
    rows = frame([(1, "a b c d e f"), (2, "a b c d e f")]).withColumn("node", F.lit(1)).withColumn("digest", F.lit("x"))
    assert sorted(map(tuple, jaccard.jaccard_components(rows).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(1000, 1100)] + [(7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in [5, *range(1000, 1100)]} == {5}


def test_common_shingles_are_found_however_often_counts_are_folded(frame):
    rows = [(i, f"the same three words {i} {i + 1} {i + 2}") for i in range(40)]
    for fold_at in (0, 50, 10**6):
        values, place = jaccard.common_shingles(frame(rows, 1), 3, 0.5, fold_at)
        assert len(values) == 2 and sorted(place) == [0, 1]
    assert len(jaccard.common_shingles(frame([]), 3)[0]) == 0
