import random

import numpy as np
from pyspark.sql import functions as F

from scorelake.llm import linededup


def brute(rows, k, long_words=linededup.LONG_WORDS):
    """Rows must have different ids; ties of id aren't drawn here."""
    seen, alone, out = set(), set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        lines = (text or "").split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip()]
        gone, runs = set(), []
        for i in range(len(solid) - k + 1):
            run = tuple(lines[j] for j in solid[i : i + k])
            if run in seen:
                gone.update(solid[i : i + k])
            seen.add(run)
        for i in solid:
            if len(lines[i].split()) >= long_words:
                if (lines[i], "alone") in alone:
                    gone.add(i)
                alone.add((lines[i], "alone"))
        kept = None if text is None else [x for i, x in enumerate(lines) if i not in gone and x.strip()]
        out.append((doc_id, kept, len(solid), len(gone)))
    return out


def test_equals_brute_force(frame):
    for seed, k in ((1, 2), (2, 3), (3, 1)):
        rnd = random.Random(seed)
        line = lambda: rnd.choice(["", "  ", *"abcdéfgh"])
        rows = [(i, "\n".join(line() for _ in range(rnd.randint(0, 14)))) for i in range(60)] + [(100, None), (None, "a\nb\nc")]
        rows += [(200 + i, "\n".join(rnd.choice(["one two three", "a b c d", "a", ""]) for _ in range(rnd.randint(1, 4)))) for i in range(9)]
        for long_words in (2, 50):
            got = linededup.dedup_lines(frame(rows), k, long_words).collect()
            assert plain(got) == sorted(brute(rows, k, long_words), key=repr)


def test_hot_lines_and_hot_matches_equal_brute_force(frame):
    rnd = random.Random(4)
    line = lambda: rnd.choice(["hot", "hot", "warm one", *"abcdefgh"])
    rows = [(i, "\n".join(line() for _ in range(rnd.randint(0, 12)))) for i in range(120)] + [(200 + i, "hot\nhot\nend") for i in range(40)]
    want = sorted(brute(rows, 2, 2), key=repr)
    for hot_share in (1e-4, 0.02, 0.1, 1.0):  # all, some and no lines are hot
        assert plain(linededup.dedup_lines(frame(rows), 2, 2, hot_share).collect()) == want


def plain(got):
    return sorted(((r.doc_id, None if r.text is None else [x for x in r.text.split("\n") if x.strip()], r.n_lines, r.n_removed) for r in got), key=repr)


def test_equal_windows_select_equal_lines():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 30, 500).astype(np.uint64)
    for width in (1, 2, 5):
        place = linededup.selected(h, width)
        assert all(h[p] == h[i : i + width].min() and i <= p < i + width for i, p in enumerate(place))
        kept = {}
        for i, p in enumerate(place):
            assert kept.setdefault(tuple(h[i : i + width]), p - i) == p - i
    assert len(linededup.selected(h[:1], 2)) == 0


def test_any_column_names_and_very_long_texts(frame):
    long = "\n".join(f"line {i}" for i in range(100_000))
    rows = frame([(1, long), (2, long), (2, "new\n" + long + "\nlast"), (None, None), (3, "w " * 60), (4, "w " * 60)])
    clash = rows.select("doc_id", "text", *[F.lit(n).alias(n) for n in ("_row", "_repeats", "_doc", "row", "match", "first", "n", "fingerprint")])
    got = linededup.dedup_lines(clash)
    assert got.columns == [*clash.columns, "n_lines", "n_removed"]
    assert all(r["_row"] == "_row" and r["_repeats"] == "_repeats" and r["_doc"] == "_doc" for r in got.collect())
    texts = sorted(((r.doc_id, r.text, r.n_removed) for r in got.collect()), key=repr)
    assert (2, "new\nlast", 100_000) in texts and (1, long, 0) in texts and (None, None, 0) in texts and (4, "", 1) in texts


def test_copies_keep_one_and_columns_stay(frame):
    rows = frame([(3, "a\nb"), (1, "a\nb"), (1, "a\nb"), (9, "z")]).withColumn("n_lines", F.lit("x")).withColumn("lang", F.lit("en"))
    got = linededup.dedup_lines(rows)
    assert got.columns == ["doc_id", "text", "lang", "n_lines", "n_removed"]
    assert {r.text for r in got.where("doc_id = 3").collect()} == {""}
    assert got.where("doc_id = 9").first().text == "z"
    assert linededup.dedup_lines(frame([])).collect() == []


def test_a_selected_line_is_one_row(frame):
    """Winnowing thins out: n distinct lines give fewer rows than windows, about 2 n / (width + 1)."""
    text = "\n".join(f"line {i}" for i in range(3000))
    for width in (2, 3, 8):
        places = frame([(1, text)], 1).select("doc_id", F.lit(0).cast("long").alias("row"), "text").mapInArrow(linededup._positions(width, 50), linededup.POSITIONS).collect()
        assert sum(len(r.matches) for r in places) == 3000 - width + 1
        assert 0.85 < len(places) * (width + 1) / (2 * 3000) < 1.15
        assert len(places) < 3000 - width
