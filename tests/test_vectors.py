from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marani.functions import vectors as V
from marani.operators import emoji, evaluation, layout, lookup, neighbours, quality


def frame(spark, m, name="vec"):
    return spark.createDataFrame([(n, [float(x) for x in row]) for n, row in enumerate(m)], f"i long, {name} array<double>")


def brute(m, k):
    u = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    cos = np.round(u @ u.T, 12)
    return {(i, r): j for i in range(len(m)) for r, j in enumerate(sorted((x for x in range(len(m)) if x != i), key=lambda x: (-cos[i, x], x))[:k])}


@pytest.mark.parametrize("sent", [1 << 30, 0])
def test_exact_neighbours(spark, monkeypatch, sent):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 17)
    m = np.random.default_rng(1).normal(size=(60, 8))
    m[5], m[6], m[7] = m[4], m[4] * 2, 0  # equal, of equal direction, zero
    got = neighbours.exact_neighbours(frame(spark, m), 5, sent_bytes=sent).collect()
    assert {(r["i"], r["rank"]): r["j"] for r in got} == brute(m, 5)
    assert all(r["sim_u8"] == round(max(0, min(1, r["cos"])) * 255) for r in got)
    few = neighbours.exact_neighbours(frame(spark, m[:3]), 5, sent_bytes=sent).collect()
    assert len(few) == 6
    assert neighbours.exact_neighbours(frame(spark, m[:1]), 5, sent_bytes=sent).count() == 0
    assert neighbours.exact_neighbours(frame(spark, m).limit(0), 5, sent_bytes=sent).count() == 0


def test_packing(spark):
    df = spark.createDataFrame([(0, 1, 7, 3), (0, 0, 513, 200), (1, 0, 65535, 255)], "i int, rank int, j long, sim_u8 int")
    packed = {r["i"]: bytes(r["record"]) for r in neighbours.pack_neighbours(df).collect()}
    assert packed == {0: bytes([1, 2, 200, 7, 0, 3]), 1: bytes([255, 255, 255])}
    back = neighbours.unpack_neighbours(neighbours.pack_neighbours(df)).collect()
    assert {(r["i"], r["rank"], r["j"], r["sim_u8"]) for r in back} == {(0, 0, 513, 200), (0, 1, 7, 3), (1, 0, 65535, 255)}
    with pytest.raises(Exception, match="16 bits"):
        neighbours.pack_neighbours(df.withColumn("j", F.lit(70000))).collect()


def test_wide_packing(spark):
    rows = {(0, 0, 65_536, 200), (0, 1, -1, 3), (1, 0, 2**31 - 1, 255), (1, 1, -(2**31), 0), (1, 2, 7, 9)}
    packed = neighbours.pack_neighbours(spark.createDataFrame(sorted(rows), "i int, rank int, j long, sim_u8 int"), 4)
    assert {len(r["record"]) for r in packed.collect()} == {10, 15}
    back = neighbours.unpack_neighbours(packed, 4)
    assert {tuple(r) for r in back.collect()} == rows
    assert back.schema == neighbours.unpack_neighbours(packed).schema
    cut = packed.withColumn("record", F.substring("record", 1, 6))
    assert neighbours.unpack_neighbours(cut, 4).count() == 0 and neighbours.unpack_neighbours(cut).count() == 4


def test_int8(spark):
    m = np.random.default_rng(2).normal(size=(50, 128))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    z = frame(spark, m).select("i", V.quantize_i8(F.col("vec")).alias("z"))
    pairs = z.join(z.select((F.col("i") + 1).alias("i"), F.col("z").alias("y")), "i").select("i", V.int8_cosine(F.col("z"), F.col("y")).alias("c")).collect()
    assert max(abs(r["c"] - m[r["i"]] @ m[r["i"] - 1]) for r in pairs) < 2e-2
    zero = frame(spark, [[0.0, 0.0]]).select(V.quantize_i8(F.col("vec")).alias("z"), V.l2_normalize(F.col("vec")).alias("u")).first()
    assert zero["z"]["scale"] == 1 and zero["u"] == [0.0, 0.0]


def points(spark, p):
    return spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in enumerate(p)], "i long, x double, y double")


@pytest.mark.parametrize("mirror", [1, -1])
def test_procrustes(spark, mirror):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 2))
    turn = np.array([[math.cos(0.7), -math.sin(0.7)], [math.sin(0.7), math.cos(0.7)]]) @ np.diag([1, mirror])
    y = 1.5 * x @ turn.T + 4
    got = {r["i"]: (r["x"], r["y"]) for r in layout.procrustes(points(spark, x), points(spark, y)).collect()}
    assert np.abs(np.array([got[n] for n in range(40)]) - y).max() < 1e-9
    d = layout.displacement(points(spark, y), points(spark, y)).first()
    assert d["median"] == d["p95"] == 0
    noisy = y + rng.normal(scale=0.3, size=y.shape)  # against the solution by singular values
    xc, yc = x - x.mean(0), noisy - noisy.mean(0)
    u, s, vt = np.linalg.svd(xc.T @ yc)
    want = s.sum() / (xc**2).sum() * xc @ u @ vt + noisy.mean(0)
    got = {r["i"]: (r["x"], r["y"]) for r in layout.procrustes(points(spark, x), points(spark, noisy)).collect()}
    assert np.abs(np.array([got[n] for n in range(40)]) - want).max() < 1e-9


def test_box(spark):
    p = np.random.default_rng(4).normal(size=(100, 2)) * [3, 1]
    got = np.array([(r["x"], r["y"]) for r in layout.fit_box(points(spark, p)).collect()])
    assert np.abs(got).max() <= 1 + 1e-6 and np.abs(got[:, 0]).max() > 1 - 1e-9
    assert layout.fit_box(points(spark, [(2, 2)])).first()["x"] == 0


def test_pca(spark):
    m = np.random.default_rng(5).normal(size=(80, 6)) * [5, 3, 2, 1, 1, 1] + 7
    c = m - m.mean(0)
    want = c @ np.linalg.svd(c, full_matrices=False)[2][:3].T
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    got = np.array([r["vec"] for r in layout.pca_reduce(frame(spark, m), 3).orderBy("i").collect()])
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-6


def test_umap_keeps_neighbourhoods(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 16)) * 4
    m = np.concatenate([c + rng.normal(size=(30, 16)) * 0.5 for c in centres])
    got = layout.umap_layout(frame(spark, m), 10, epochs=100).orderBy("i").collect()
    again = layout.umap_layout(frame(spark, m).repartition(5), 10, epochs=100).orderBy("i").collect()
    p = np.array([(r["x"], r["y"]) for r in got])
    assert np.allclose(p, [(r["x"], r["y"]) for r in again])
    d = ((p[:, None] - p[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    label = np.arange(120) // 30
    assert (label[np.argsort(d, axis=1)[:, :10]] == label[:, None]).mean() > 0.95
    assert layout.umap_layout(frame(spark, m[:2])).count() == 2


def test_evaluation(spark):
    m = np.random.default_rng(7).normal(size=(30, 6))
    words = [f"w{n}" for n in range(30)]
    v = spark.createDataFrame([(w, [float(x) for x in r]) for w, r in zip(words, m)], "word string, vec array<double>")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)

    def order(target, out):
        return [w for _, w in sorted((-round(float(target @ u[n] / np.linalg.norm(target)), 9), w) for n, w in enumerate(words) if w not in out)]

    q = spark.createDataFrame([("w0", "w1", "w2", "w3"), ("w4", "w5", "w6", "none")], "a string, b string, c string, d string")
    want = order(u[1] + u[2] - u[0], {"w0", "w1", "w2"})
    assert {(r["a"], r["rank"]) for r in evaluation.analogy_rank(q, v).collect()} == {("w0", want.index("w3")), ("w4", -1)}
    top = evaluation.analogy_topk(q.limit(1), v, 4).orderBy("rank").collect()
    assert [r["candidate"] for r in top] == want[:4]
    related = spark.createDataFrame([("w0", "w9"), ("w0", "zz")], "subject string, term string")
    assert {(r["term"], r["rank"]) for r in evaluation.related_ranks(related, v).collect()} == {("w9", order(u[0], {"w0"}).index("w9")), ("zz", -1)}
    trials = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9)], "n int, value double")
    assert [r["n"] for r in evaluation.best_trials(trials).collect()] == [3, 1, 2]


def test_probes_and_gate(spark):
    v = spark.createDataFrame([(0, "დედა"), (1, "მამა"), (2, "მთები"), (3, "დედამ")], "i int, word string")
    near = spark.createDataFrame([(0, 1), (2, 3)], "i int, j int")
    p = spark.createDataFrame([("დედას", ["მამას"], []), ("მთებს", ["ცა"], ["დედა"]), ("ზღვა", ["x"], [])], "word string, expected array<string>, forbidden array<string>")
    r = evaluation.probe_metrics(p, v, near).first().asDict()
    assert r == {"probes": 3, "present": 2, "hits": 1, "forbidden": 1, "hit_rate": 0.5}
    bad = frame(spark, [[1.0, float("nan")], [float("inf"), 0.0], [1.0, 2.0]])
    checks = quality.gate(quality.finite(bad, "vec"), quality.neighbours_in_range(near, 3), quality.at_most(v, 3), quality.equal_counts(v, near), quality.count_is(v, 4)).collect()
    assert sorted({c["check"] for c in checks}) == ["equal_counts", "finite", "neighbour_range", "vocabulary_ceiling"]
    assert len([c for c in checks if c["check"] == "finite"]) == 2
    sets = spark.createDataFrame([("a", "g", True, 0.9, "h"), ("b", "g", False, 0.5, "k"), ("c", None, False, None, "z")], "id string, aligned_group string, reference boolean, median double, vocab_hash string")
    assert [r["detail"] for r in quality.displacement_below(sets).collect()] == ["b"] and [r["detail"] for r in quality.one_hash_per_group(sets).collect()] == ["g"]


def test_emoji(spark):
    k = spark.createDataFrame([("a", 0, "მზე"), ("a", 1, "დიდი ცა"), ("a", 2, "მზე"), ("b", 0, "უცხო")], "emoji string, rank int, keyword string")
    v = spark.createDataFrame([(4, "მზე", 3), (2, "მზე", 9), (5, "ცა", 7)], "i int, word string, freq long")
    m = {(r["emoji"], r["i"]): r["weight"] for r in emoji.match_words(k, v).collect()}
    assert m == {("a", 2): 1.0, ("a", 5): pytest.approx(0.325)}
    made = emoji.compose(emoji.match_words(k, v), spark.createDataFrame([(2, [1.0, 0.0]), (5, [0.0, 1.0])], "i int, vec array<double>"), v).first()
    assert made["freq"] == 9 and made["vec"][0] / made["vec"][1] == pytest.approx(1 / 0.325)
    c = emoji.coverage(spark.createDataFrame([("a",)], "emoji string"), k).first()
    assert (c["placed"], c["asked"], c["enough"]) == (1, 2, True)
    assert spark.createDataFrame([(" a|| b \t|",)], "f string").select(emoji.plain_keywords(F.col("f"))).first()[0] == ["a", "b"]


def test_lookup(spark):
    v = spark.createDataFrame([(0, "მთა", 5), (1, "მთები", 9), (2, "ტბა", None)], "i int, word string, freq long")
    assert [r["i"] for r in lookup.prefix_search(v, "მთ").collect()] == [1, 0]
    assert [r["i"] for r in lookup.fuzzy_search(v, "მთე").collect()] == [0, 1]
    a, b = points(spark, [(0, 0)]), points(spark, [(1, 2)])
    assert [tuple(lookup.morph(a, b, t).first())[1:] for t in (0, 1)] == [(0, 0), (1, 2)] and lookup.morph(a, b, 0.5).first()["x"] == pytest.approx(0.5)
