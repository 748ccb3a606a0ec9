"""Each stage of the pipeline against its brute-force version on its own input."""

import random

import pytest

import corpus_pipeline
from scorelake.llm import packing, quality
from scorelake.llm._spark import materialise
from tests.llm.test_jaccard import shingles
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_small_operators import brute_hits, words_of

BENCHMARK = [(1, " ".join(f"bench{i}" for i in range(14))), (2, " ".join(f"other{i}" for i in range(12)))]


def documents():
    rnd = random.Random(11)
    vocabulary = [f"word{i}" for i in range(300)]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    rows = [(i, "\n".join(say(rnd.randint(6, 20)) for _ in range(rnd.randint(1, 5)))) for i in range(150)]
    rows += [(200 + i, "$$ %% ## " * 8 + rnd.choice(["@@", "!!"])) for i in range(60)]
    base = say(120).split()
    for i in range(8):  # near copies
        words = list(base)
        for _ in range(i % 3):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((300 + i, " ".join(words)))
    passage = say(12) + "\n" + say(12) + "\n" + say(9)
    rows += [(400 + i, say(9) + "\n" + passage + "\n" + say(8)) for i in range(5)]
    rows += [(500, say(8) + " " + BENCHMARK[0][1] + " " + say(5)), (501, BENCHMARK[1][1]), (502, None), (503, "")]
    return [(i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 0 if i >= 200 else 1, 0) for i in [*range(0, 150, 2), *range(200, 260, 2)]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_and_the_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = {r.doc_id: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, folder), "test-stage")
        if name != "best_fit_packing":
            assert docs.columns == corpus_pipeline.COLUMNS
            for r in docs.collect():
                assert r.n_chars == (len(r.text) if r.text is not None else None)
                before = given[name][r.doc_id]
                assert (r.lang, r.source) == (before.lang, before.source)
    given["end"] = {}

    # Quality: the junk goes, clean documents stay.
    kept = given["line_dedup"]
    assert not [i for i in kept if 200 <= i < 260] and all(i in kept for i in range(150))

    # Line dedup: later runs of two lines and later long lines go; documents that were nothing else go as well.
    want = {}
    for doc_id, lines, n, gone in brute_lines([(i, r.text) for i, r in kept.items()], corpus_pipeline.linededup.MIN_LINES):
        if not gone or gone < n:
            want[doc_id] = lines
    got = {i: None if r.text is None else [x for x in r.text.split("\n") if x.strip()] for i, r in given["ngram_jaccard_join"].items()}
    assert got == want

    # Near-duplicates: the smallest id of each component stays.
    before = given["ngram_jaccard_join"]
    sets = {i: shingles(r.text, 5) for i, r in before.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(given["benchmark_decontamination"]) == sorted(i for i in sets if find(i) == i)
    assert sum(300 <= i < 308 for i in given["benchmark_decontamination"]) == 1

    # Decontamination: hit words go, and documents without another word.
    after = given["best_fit_packing"]
    for i, r in given["benchmark_decontamination"].items():
        _, hit, _ = brute_hits(r.text, BENCHMARK, 10)
        words = words_of(r.text)
        left = [w for k, w in enumerate(words) if k not in hit]
        assert (i in after) == (not hit or bool(left))
        if i in after:
            assert words_of(after[i].text) == left
    assert 501 not in after and "bench3" not in after[500].text

    # Packing: each document's tokens once; the run gives the same pieces.
    encoder = packing.Encoder(packing.tokenizer_path())
    tokens = {i: len(encoder.encode(r.text or "")) // 4 + 1 for i, r in after.items()}
    pieces = docs.collect()
    assert {i: sum(p.length for p in pieces if p.doc_id == i) for i in after} == tokens
    run = corpus_pipeline.run(spark, folder).collect()
    key = lambda rows: sorted((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in rows)
    assert key(run) == key(pieces)
    assert quality.MAX_TRAIN > 0


def test_odd_rows_and_empty_tables(spark, folder, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, node string"
    odd = [(None, "no id, but words", "en", "s", 16, "x", "y"), (None, None, None, None, None, None, None), (3, "", "en", "s", 0, "x", "y"), (4, "same text here twice", "en", "s", 20, "x", "y")]
    for rows in (odd + odd[-1:], []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, folder), "test-stage")
            if name != "best_fit_packing":
                assert docs.columns == corpus_pipeline.COLUMNS
        got = docs.collect()
        if rows:
            assert {None, 4} <= {r.doc_id for r in got} and sum(r.doc_id == 4 for r in got) == 1
        else:
            assert got == []


def test_near_duplicates_are_told_by_row(spark):
    """A near copy goes though another row has its id; of rows equal in id and text one stays."""
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    a, other = " ".join(words), " ".join(f"x{i}" for i in range(40))
    rows = [(1, a), (5, a + " end"), (5, other), (7, "unlike any"), (7, "unlike any"), (None, None), (None, "no id here at all")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, a), (5, other), (7, "unlike any"), (None, None), (None, "no id here at all")], key=repr)
