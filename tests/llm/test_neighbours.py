from __future__ import annotations

import numpy as np
import pytest

from marani.llm import neighbours as N


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "i int, vec128 array<float>")


def clusters(seed, groups, size, dimensions=16):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(size=(1, dimensions)) + 0.15 * rng.normal(size=(size, dimensions)) for _ in range(groups)]).astype("f4")


def exact(m, k):
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    cos = u @ u.T
    np.fill_diagonal(cos, -9)
    return {(min(i, j), max(i, j)) for i in range(len(m)) for j in sorted(range(len(m)), key=lambda j: (-round(float(cos[i, j]), 6), j))[:k] if j != i}


@pytest.mark.parametrize("largest", [100_000, 40])
def test_recall(spark, monkeypatch, largest):
    monkeypatch.setattr(N, "LARGEST_GROUP", largest)  # the second way: groups cut into grids
    m = clusters(1, 40, 25)
    got = {(r["i_a"], r["i_b"]) for r in N.neighbour_pairs(frame(spark, enumerate(m)), 5, dimensions=16).collect()}
    want = exact(m, 5)
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.95


def test_a_third_equal(spark):
    m = clusters(2, 20, 20)
    rows = list(enumerate(m)) + [(i, m[0] * 2 ** (i % 3)) for i in range(400, 600)]
    best = {}
    for r in N.nearest(frame(spark, rows), 5, dimensions=16).collect():
        best.setdefault(r["i"], {})[r["rank"]] = r["j"]
    same = [0, *range(400, 600)]
    for i in same:
        assert [best[i][n] for n in range(1, 6)] == [j for j in same if j != i][:5]
    assert len(best) == 600


def test_ties_by_id(spark, monkeypatch):
    monkeypatch.setattr(N, "LARGEST_GROUP", 60)
    rng = np.random.default_rng(6)
    middles = 3 * rng.normal(size=(20, 16))
    # Around each middle six equal vectors and three others of which they are the best.
    rows = [v for m in middles for v in [m] * 6 + [m + 0.4 * rng.normal(size=16) for _ in range(3)]]
    ids = rng.permutation(1000)[: len(rows)].tolist()
    got = {}
    for r in N.nearest(frame(spark, list(zip(ids, rows))), 5, dimensions=16).orderBy("rank").collect():
        got.setdefault(r["i"], []).append((r["j"], r["sim"]))
    seen = 0
    for g in range(20):
        equal = sorted(ids[9 * g : 9 * g + 6])
        for x in ids[9 * g + 6 : 9 * g + 9]:
            best = got[x]
            if best[0][1] - best[4][1] < 1e-6 and {j for j, _ in best} <= set(equal):
                seen += 1
                assert [j for j, _ in best] == equal[:5]
    assert seen > 10


def test_edges(spark):
    v = clusters(3, 1, 6)
    rows = [(n, x) for n, x in enumerate(v)] + [(0, v[0]), (10, None), (11, [0] * 16), (12, v[0][:15]), (13, [float("nan"), *v[0][1:]]), (14, [float("inf"), *v[0][1:]]), (15, [None, *v[0][1:]]), (None, v[1]), (16, v[0] * 1e-30), (17, v[1] * 1e30)]
    df = frame(spark, rows).selectExpr("*", "1 AS v", "2 AS j", "3 AS sim", "4 AS h1")
    got = {(r["i_a"], r["i_b"]) for r in N.neighbour_pairs(df, 5, dimensions=16).collect()}
    ids = {i for p in got for i in p}
    assert ids == {0, 1, 2, 3, 4, 5, 16, 17} and all(a < b for a, b in got)
    assert N.neighbour_pairs(df.limit(0), 5, dimensions=16).count() == 0
    assert N.neighbour_pairs(df.limit(1), 5, dimensions=16).count() == 0
    assert {(r["i_a"], r["i_b"]) for r in N.neighbour_pairs(df.limit(3), 5, dimensions=16).collect()} == {(0, 1), (0, 2), (1, 2)}


def test_perturbations():
    sets = N.perturbations(4, 12)
    assert sets[0] == (0,) and len(set(sets)) == 12 and all(len(set(s)) == len(s) for s in sets)
    assert not any(7 - r in s for s in sets for r in s)
    m = 4
    cost = lambda s: sum((r + 1) * (r + 2) / (4 * (m + 1) * (m + 2)) if r < m else 1 - (2 * m - r) / (m + 1) + (2 * m - r) * (2 * m + 1 - r) / (4 * (m + 1) * (m + 2)) for r in s)
    assert [cost(s) for s in sets] == sorted(cost(s) for s in sets)


def test_probes_are_adjacent():
    h = N.fit(clusters(5, 10, 20), 200)
    v = clusters(6, 5, 4)
    found, _ = h.buckets(v, 0, True)
    assert found.shape == (20, 1 + N.PROBES) and all(len(set(r)) == 1 + N.PROBES for r in found.tolist())
    assert (found[:, 0] == h.buckets(v, 0, False)[0][:, 0]).all()


def test_many_nearly_equal():
    rng = np.random.default_rng(8)
    v = (rng.normal(size=(1, 16)) + 1e-8 * rng.normal(size=(700, 16))).astype("f4")
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    search = N.Search(np.arange(700)[::-1].copy(), v, 5)
    members = np.arange(700)[::-1].copy()
    search.compare(np.arange(700), members, both=True)
    assert sum(len(r) for r, _, _ in search.pairs) <= 2 * 700 * 40
    got = {i: list(j) for i, j in zip(*(search.result().column(c).to_pylist() for c in ("i", "j")))}
    cos = np.round(v.astype(np.float64) @ v.astype(np.float64).T, 12)
    for i in range(0, 700, 50):
        row = 699 - i
        want = sorted((j for j in range(700) if j != i), key=lambda j: (-cos[row, 699 - j], j))[:5]
        assert got[i] == want
