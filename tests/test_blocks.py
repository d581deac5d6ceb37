from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from marani.functions import vectors as V
from marani.operators import contexts, evaluation, lookup


def test_nearest_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(90, 6)).round(1)
    m[40] = m[3] * 2  # a tie
    m[50] = 0
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(99, None), (None, m[0].tolist())], "i long, vec array<double>")
    q = v.where("i % 10 = 3 or i is null").select(F.col("i").cast("string").alias("q"), F.col("vec").alias("qv"))
    u = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    want = {str(a): sorted(range(90), key=lambda b: (-round(float(u[a] @ u[b]), 9), b))[:5] for a in range(3, 90, 10)}
    for rows in (4096, 7):
        monkeypatch.setattr(lookup, "BLOCK_ROWS", rows)
        got = {}
        for r in lookup.nearest_to(q, v, 5).collect():
            got.setdefault(r["q"], []).append((-round(r["cos"], 9), r["i"]))
        assert {a: [i for _, i in sorted(b)] for a, b in got.items()} == want
    assert lookup.nearest_to(q.limit(0), v, 5).count() == 0 == lookup.nearest_to(q, v.limit(0), 5).count()


def test_queries_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    v = spark.createDataFrame([(str(i), x.tolist()) for i, x in enumerate(rng.normal(size=(40, 5)))], "word string, vec array<double>")
    asked = spark.createDataFrame([(str(a), str(a + 1), str(a + 2), str(a + 3)) for a in range(20)], "a string, b string, c string, d string")
    whole = sorted(map(tuple, evaluation.analogy_rank(asked, v).collect()))
    monkeypatch.setattr(evaluation, "QUERIES_AT_ONCE", 6)
    assert sorted(map(tuple, evaluation.analogy_rank(asked, v).collect())) == whole


def test_weighted_sums(spark):
    rng = np.random.default_rng(6)
    rows = [("hot" if n % 3 else f"k{n % 7}", float(n % 4), rng.normal(size=4).tolist()) for n in range(600)] + [(None, 1.0, [1.0] * 4), ("n", None, [1.0] * 4), ("n", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, w double, v array<double>").repartition(5).selectExpr("*", "1 AS total", "2 AS weight")
    got = {r["k"]: (r["total"], r["weight"]) for r in V.weighted_sums(df, "k", F.col("w"), F.col("v")).collect()}
    for k in {k for k, w, v in rows if k and w is not None and v}:
        own = [(w, np.array(v)) for a, w, v in rows if a == k]
        assert np.allclose(got[k][0], sum(w * v for w, v in own)) and got[k][1] == sum(w for w, _ in own)
    assert set(got) == {k for k, w, v in rows if k and w is not None and v}
    assert V.weighted_sums(df.limit(0), "k", F.col("w"), F.col("v")).count() == 0


def test_span_pooling(spark):
    # Word 1 has two contexts; tokens beside the span and without width don't count; word 2 has no token in its span.
    rows = [
        (1, 0, 0, 0, [9.0, 9.0], 2, 6), (1, 0, 0, 2, [8.0, 0.0], 2, 6), (1, 0, 2, 4, [1.0, 0.0], 2, 6), (1, 0, 4, 7, [3.0, 0.0], 2, 6), (1, 0, 4, 4, [7.0, 7.0], 2, 6),
        (1, 1, 0, 3, [0.0, 4.0], 0, 3), (2, 0, 0, 3, [1.0, 1.0], 5, 9), (None, 0, 0, 3, [1.0, 1.0], 0, 3),
    ]
    df = spark.createDataFrame(rows, "i int, row int, at int, until int, vec array<double>, start int, end int")
    got = {r["i"]: (r["vec"], r["n_used"]) for r in contexts.span_pooled(df).collect()}
    assert set(got) - {None} == {1} and got[1][1] == 2
    assert np.allclose(got[1][0], np.array([2.0, 4.0]) / np.hypot(2, 4))
