import random
import re

import numpy as np

from scorelake.llm import substring


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = {}
    for words in texts:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abçXY.") for _ in range(rnd.randint(1, 4)))
    shared = [[word() for _ in range(rnd.randint(5, 30))] for _ in range(4)]
    rows = [(None, "null id " * 9), (7, None), (8, ""), (9, "\n\t "), (10, "x " * 50), (11, "x " * 9)]
    for i in range(20, 20 + n):
        parts = [[word() for _ in range(rnd.randint(0, 25))]]
        if rnd.random() < 0.7:
            parts += [rnd.choice(shared), [word() for _ in range(rnd.randint(0, 9))]]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(w for p in parts for w in p)))
    return rows + rows[-5:] + [(900 + i, rows[30][1]) for i in range(12)]


def test_equals_brute_force_with_and_without_common_blocks(frame):
    for seed, share in ((1, 0.01), (2, 1.0), (3, 0.2)):
        rows = corpus(seed)
        got = rows_of(substring.remove_repeats(frame(rows), window=8, seed=3, share=share, index_windows=40 * seed))
        assert got == brute(rows, 8)


def test_factors_are_longest_matches_that_refer_to_an_equal_place(frame):
    for share in (0.05, 1.0):
        rows = [r for r in corpus(5) if r[0] is not None]
        words = {}
        for i, t in rows:
            words.setdefault(i, []).append(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        found = substring.duplicate_factors(frame(rows), window=8, seed=3, share=share).collect()
        assert found
        for f in found:
            n = f.n + 7
            own = {tuple(w[f.first : f.first + n]) for w in words[f.doc_id]}
            assert own & {tuple(w[f.reference_first : f.reference_first + n]) for w in words[f.reference]}
            assert (f.doc_id, f.first) != (f.reference, f.reference_first) or len(words[f.doc_id]) > 1


def test_greedy_factors_equal_brute_force():
    rng = np.random.default_rng(4)
    for n, sigma, cut in ((1, 2, 1), (40, 3, 5), (300, 4, 9), (300, 200, 20), (200, 1, 7)):
        key, stretch = rng.integers(0, sigma, n).astype(np.uint64), np.arange(n) // cut
        lists = [key[stretch == i].tolist() for i in range(stretch[-1] + 1)]
        want = []
        for i, own in enumerate(lists):
            at = 0
            while at < len(own):
                best = 0
                for j, other in enumerate(lists):
                    for k in range(len(other)):
                        size = 0
                        while (i, at) != (j, k) and at + size < len(own) and k + size < len(other) and own[at + size] == other[k + size]:
                            size += 1
                        best = max(best, size)
                if best:
                    want.append((i * cut + at, best))
                at += max(best, 1)
        at, length, source = substring.greedy_factors(key, stretch)
        assert sorted(zip(at.tolist(), length.tolist())) == want
        for a, m, b in zip(at, length, source):
            assert a != b and (key[a : a + m] == key[b : b + m]).all() and stretch[b] == stretch[b + m - 1]


def test_very_long_texts(frame):
    rnd = random.Random(8)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(150_000)]
    got = rows_of(substring.remove_repeats(frame([(1, " ".join(words)), (2, " ".join(words[40_000:90_000])), (3, "x")])))
    assert [(r[0], r[2]) for r in got] == [(1, 50_000), (2, 50_000), (3, 0)]


def test_empty_table_and_other_columns(frame):
    from pyspark.sql import functions as F

    assert rows_of(substring.remove_repeats(frame([]), window=5)) == []
    rows = [(1, "a b c d e f"), (2, "a b c d e g")]
    with_clash = frame(rows).withColumn("n_words", F.lit("x")).withColumn("first", F.lit(1))
    assert rows_of(substring.remove_repeats(with_clash, window=5)) == [(1, 6, 5, "f"), (2, 6, 5, "g")]
