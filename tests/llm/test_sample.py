from __future__ import annotations

import collections
import math

from marani.llm import sample as S


def draw(df, size, seed=1, **k):
    return S.sample(df, size, ["sid", "pos"], ["piece"], ["lemma"], seed, **k).collect()


def frame(spark, n, copies=1):
    rows = [(s // 10, s % 10, p, f"l{s % 3}") for s in range(n) for p in range(copies)]
    return spark.createDataFrame(rows, "sid long, pos int, piece int, lemma string")


def test_uniform(spark):
    df = frame(spark, 300).cache()
    hits = collections.Counter((r["sid"], r["pos"]) for seed in range(60) for r in draw(df, 60, seed))
    assert sum(hits.values()) == 60 * 60 and len(hits) == 300
    chi = sum((hits[s // 10, s % 10] - 12) ** 2 / (12 * 0.8) for s in range(300))
    assert abs(chi - 299) < 5 * math.sqrt(2 * 299)


def test_delivered_again_and_in_pieces(spark):
    once, twice = frame(spark, 500), frame(spark, 500, 3)
    a, b, c = (sorted(map(tuple, draw(x, 50))) for x in (once, twice, twice.repartition(7)))
    assert a == b == c and len(a) == 50
    assert len(draw(once, 500)) == 500 == len(draw(twice, 501))


def test_bounds_hold_and_widen(spark):
    df = frame(spark, 2000).cache()
    keys = sorted(r[0] for r in df.select(S.random_key(["sid", "pos"], 1)).collect())
    for size in (1, 10, 100, 1999):
        low, high = S.bounds(size, 2000, S.DOUBT)
        assert 0 <= low <= size / 2000 <= high <= 1
        assert sum(k < S._hex(low) for k in keys) <= size <= sum(k < S._hex(high) for k in keys)
    got = draw(df, 100, doubt=0.9)  # bounds so narrow that they fail
    assert sorted(map(tuple, got)) == sorted(map(tuple, draw(df, 100)))


def test_edges(spark):
    rows = [(None, 1, 1, "a"), (None, 1, 2, "b"), (1, None, 1, None), (1, 1, None, "x"), (1, 1, 5, "y")]
    df = spark.createDataFrame(rows, "sid long, pos int, piece int, lemma string").selectExpr("*", "'k' AS __key", "1 AS first")
    got = {(r["sid"], r["pos"]): r["lemma"] for r in draw(df, 10)}
    assert got == {(None, 1): "a", (1, None): None, (1, 1): "x"}
    assert len(draw(df, 2)) == 2 and draw(df.limit(0), 5) == [] == draw(df, 0)
