"""Near duplicates of embeddings against comparing all pairs."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from scorelake.llm import neardup

@pytest.fixture(autouse=True)
def one_round(monkeypatch):
    """All tables at once, as small tables gain nothing from rounds."""
    monkeypatch.setattr(neardup, "TABLES_A_ROUND", 20)


SCHEMA = "vec_id long, embedding array<double>, label int, n_links string, core int"


def brute(rows, least=0.93):
    """(n_links, component_id) of each row by all pairs."""
    usable = [v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    groups = {}
    for i, (_, v, label) in enumerate(rows):
        if usable[i]:
            groups.setdefault((label, len(v)), []).append(i)
    for own in groups.values():
        x = np.array([rows[i][1] for i in own], float)
        x /= np.abs(x).max(1)[:, None]
        norms = np.linalg.norm(x, axis=1)
        cosine = x @ x.T / np.outer(norms, norms)
        for a, b in zip(*np.nonzero(np.triu(cosine >= least, 1))):
            i, j = own[a], own[b]
            pairs.add((i, j))
            links[i], links[j] = links[i] + 1, links[j] + 1
            root[max(top(i), top(j))] = min(top(i), top(j))
    members = {}
    for i in range(len(rows)):
        members.setdefault(top(i), []).append(rows[i][0])
    first = {t: min((x for x in ids if x is not None), default=None) for t, ids in members.items()}
    return [(rows[i][0], links[i], first[top(i)], rows[i][0] == first[top(i)]) for i in range(len(rows))], len(pairs)


def found(spark, rows, schema=SCHEMA, parts=3):
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], schema).repartition(parts)
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()]


def order(rows):
    return sorted(rows, key=repr)


def close(rng, centre, n, spread):
    """Vectors around a centre: cosines to it of some 1 / sqrt(1 + spread**2)."""
    noise = rng.standard_normal((n, len(centre)))
    return centre / np.linalg.norm(centre) + spread * noise / np.linalg.norm(noise, axis=1)[:, None]


def test_tight_groups_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(16).tolist(), i % 3) for i in range(150)]
    for g in range(6):  # cosines of .98 and more are all but never missed
        rows += [(1000 + 50 * g + i, (v * 10.0 ** (g - 3)).tolist(), g % 3) for i, v in enumerate(close(rng, rng.standard_normal(16), 5 + g, 0.05))]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] + [1.0] * 15, 1), (2004, [float("inf")] + [1.0] * 15, 1), (2005, [None] + [1.0] * 15, 1), (2006, rows[0][1], None), (2007, rows[0][1], 99)]
    rows += [(2010, [1e300] * 16, 7), (2011, [1e-300] * 16, 7), (2012, [5e-324] * 16, 7), (2013, [1e300] * 4, 7), (2014, [2.0] * 4, 7), (2015, [2.0], 7), (2016, [9.0], 7), (2017, [-9.0], 7)]
    rows += [(None, rows[200 - 50][1], rows[150][2]), (None, None, 1), (1000, rows[150][1], rows[150][2]), (1000, rows[150][1], rows[150][2])]  # no id, repeated
    want, _ = brute(rows)
    want = [(v, n, c, k if v is not None else c is None) for v, n, c, k in want]
    assert order(found(spark, rows)) == order(want)


@pytest.mark.parametrize("limits", [{"PART": 16, "CORE_LEAST": 20, "CORE_SHARE": 0.01}, {"PART": 7, "CORE_LEAST": 10**9}, {"TABLES_A_ROUND": 4, "PART": 50, "CORE_LEAST": 20}])
def test_a_third_of_all_rows_in_one_group(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(neardup, name, value)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(24)
    group = [*close(rng, centre, 120, 0.12), *[centre] * 60, *close(rng, centre + 0.5 * rng.standard_normal(24), 40, 0.05)]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(group)] + [(1000 + i, rng.standard_normal(24).tolist(), i % 2) for i in range(300)]
    want, _ = brute(rows)
    got = found(spark, rows)
    assert sorted(r[0] for r in got) == sorted(r[0] for r in rows)
    wanted = {r[0]: r for r in want}
    assert all(r[1] <= wanted[r[0]][1] for r in got)  # none below the threshold
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert all(r[2] == wanted[r[0]][2] for r in got if r[0] < 180)


@pytest.mark.parametrize("rows", [[], [(4, None, None), (5, [1.0, 2.0], 1)]])
def test_few_rows(spark, rows):
    assert sorted(found(spark, rows)) == [(r[0], 0, r[0], True) for r in rows]


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, the hardest ones: at least nine in ten are found, and none below it."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        a, b = rng.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        angle = np.arccos(0.9305 if i % 2 else 0.9295)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (np.cos(angle) * a + np.sin(angle) * b / np.linalg.norm(b)).tolist(), 1)]
    got = {r[0]: r[1] for r in found(spark, rows)}
    want = {r[0]: r[1] for r in brute(rows)[0]}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.94 * sum(want.values())


def test_registered_query_has_its_recall(spark):
    from scorelake.llm.queries import op11_embedding_near_dedup

    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{folder}/embeddings.parquet").to_pylist()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op11_embedding_near_dedup(spark, folder).collect()}
    want = {r[0]: r[1:] for r in brute(rows)[0]}
    assert got.keys() == want.keys()
    assert sum(x[0] for x in got.values()) >= 0.9 * sum(x[0] for x in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_more_vectors_more_hyperplanes():
    sizes = [neardup.table_sizes(10**k) for k in range(3, 12)]
    assert all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(sizes, sizes[1:]))
    for bits, tables in sizes:
        assert (1 - (1 - np.arccos(0.93) / np.pi) ** bits) ** tables <= 0.02
