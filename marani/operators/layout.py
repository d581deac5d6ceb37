"""Reduction and two-dimensional layout: principal components, UMAP, Procrustes alignment, bounding boxes, displacement.

The numbers of rows here are bounded: an index of neighbours holds at most 65,535 words, so their coordinates fit the driver."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.feature import PCA
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .neighbours import exact_neighbours

CEILING = 65_535


def pca_reduce(vectors: DataFrame, dimensions: int = 128, id_col: str = "i", vec_col: str = "vec") -> DataFrame:
    """``id_col``, ``vec``: centred principal components at length 1. The signs of components are arbitrary."""
    means = vectors.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("v")).agg(Summarizer.mean(F.col("v")).alias("m"))
    centre = F.broadcast(means.select(vector_to_array("m").alias("__centre")))  # one row
    centred = vectors.crossJoin(centre).select(id_col, array_to_vector(F.zip_with(F.col(vec_col).cast("array<double>"), F.col("__centre"), lambda x, m: x - m)).alias("features"))
    model = PCA(k=dimensions, inputCol="features", outputCol="out").fit(centred)
    return model.transform(centred).select(id_col, V.l2_normalize(vector_to_array("out")).alias("vec"))


def bounding_box(points: DataFrame) -> DataFrame:
    """One row: the centre of the points (``x``, ``y``) and the scale that fits the longer side into [-1, 1]."""
    ends = points.agg(*(f(c).alias(f"{c}{n}") for c in "xy" for f, n in ((F.min, 0), (F.max, 1))))
    half = F.greatest(*((F.col(f"{c}1") - F.col(f"{c}0")) / 2 for c in "xy"))
    return ends.select(*(((F.col(f"{c}0") + F.col(f"{c}1")) / 2).alias(f"c{c}") for c in "xy"), (1 / F.greatest(half, F.lit(1e-9))).alias("scale"))


def fit_box(points: DataFrame, box: DataFrame | None = None) -> DataFrame:
    """Points moved and scaled into their own box or a given one, of which the proportions stay; beyond a given box they aren't clipped."""
    b = F.broadcast(box if box is not None else bounding_box(points))
    return points.crossJoin(b).select("i", ((F.col("x") - F.col("cx")) * F.col("scale")).alias("x"), ((F.col("y") - F.col("cy")) * F.col("scale")).alias("y"))


def procrustes(points: DataFrame, reference: DataFrame) -> DataFrame:
    """``i``, ``x``, ``y``: the points turned or mirrored, scaled and moved so that they lie as near to the reference as can be.

    In two dimensions the best orthogonal map follows from four sums, so one aggregate and one projection do."""
    r = reference.select("i", F.col("x").alias("u"), F.col("y").alias("v"))
    pairs = points.join(r, "i")
    mean = F.broadcast(pairs.agg(*(F.avg(c).alias(f"m{c}") for c in "xyuv")))
    centred = pairs.crossJoin(mean).select(*((F.col(c) - F.col(f"m{c}")).alias(c) for c in "xyuv"))
    s = centred.agg(*(F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in ("xu", "xv", "yu", "yv")), F.sum(F.col("x") * F.col("x") + F.col("y") * F.col("y")).alias("size"))
    turn = F.hypot(F.col("xu") + F.col("yv"), F.col("xv") - F.col("yu"))
    mirror = F.hypot(F.col("xu") - F.col("yv"), F.col("xv") + F.col("yu"))
    turns = turn >= mirror
    length = F.greatest(turn, mirror)
    safe = lambda n, d: F.when(d == 0, F.lit(0.0)).otherwise(n / d)
    a = F.when(turns, safe(F.col("xu") + F.col("yv"), turn)).otherwise(safe(F.col("xu") - F.col("yv"), mirror))
    b = F.when(turns, safe(F.col("xv") - F.col("yu"), turn)).otherwise(safe(F.col("xv") + F.col("yu"), mirror))
    one = F.broadcast(s.select(a.alias("a"), b.alias("b"), turns.alias("turns"), safe(length, F.col("size")).alias("k")).crossJoin(mean))
    x, y = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    sign = F.when(F.col("turns"), F.lit(1.0)).otherwise(F.lit(-1.0))
    return points.crossJoin(one).select("i", ((x * F.col("a") - y * F.col("b") * sign) * F.col("k") + F.col("mu")).alias("x"), ((x * F.col("b") + y * F.col("a") * sign) * F.col("k") + F.col("mv")).alias("y"))


def displacement(points: DataFrame, reference: DataFrame) -> DataFrame:
    """One row: the median and the 95th percentile of the distances between points and reference points of equal index."""
    r = reference.select("i", F.col("x").alias("u"), F.col("y").alias("v"))
    d = points.join(r, "i").select(F.hypot(F.col("x") - F.col("u"), F.col("y") - F.col("v")).alias("d"))
    return d.agg(F.percentile("d", 0.5).alias("median"), F.percentile("d", 0.95).alias("p95"))


def _smooth(distances: np.ndarray) -> np.ndarray:
    """Memberships of one point's neighbours: the nearest has 1, and the sum is log2 of their number."""
    nonzero = distances[distances > 0]
    rho = nonzero.min() if len(nonzero) else 0.0
    want, low, high, sigma = math.log2(len(distances)), 0.0, math.inf, 1.0
    for _ in range(64):
        total = np.exp(-np.maximum(distances - rho, 0) / sigma).sum()
        if abs(total - want) < 1e-5:
            break
        if total > want:
            high, sigma = sigma, (low + sigma) / 2
        else:
            low, sigma = sigma, sigma * 2 if high == math.inf else (sigma + high) / 2
    return np.exp(-np.maximum(distances - rho, 0) / max(sigma, 1e-3 * distances.mean(), 1e-12))


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """a, b of 1 / (1 + a d^2b), fitted to 1 up to min_dist and an exponential fall beyond, by Gauss-Newton steps."""
    d = np.linspace(0, 3 * spread, 300)[1:]
    y = np.where(d < min_dist, 1.0, np.exp(-(d - min_dist) / spread))
    a, b, damp = 1.0, 1.0, 1e-2
    error = lambda a, b: ((1 / (1 + a * d ** (2 * b)) - y) ** 2).sum()
    for _ in range(200):
        p = d ** (2 * b)
        f = 1 / (1 + a * p)
        j = np.stack([-p * f * f, -2 * a * np.log(d) * p * f * f], axis=1)
        step = np.linalg.solve(j.T @ j + damp * np.eye(2), j.T @ (y - f))
        if error(a + step[0], b + step[1]) < error(a, b):
            a, b, damp = a + step[0], b + step[1], damp / 3
        else:
            damp *= 3
    return float(a), float(b)


def umap_layout(vectors: DataFrame, n_neighbors: int = 30, min_dist: float = 0.08, epochs: int = 200, seed: int = 20260704, init: DataFrame | None = None, id_col: str = "i", vec_col: str = "vec") -> DataFrame:
    """``i``, ``x``, ``y``: a layout after the published UMAP method, for at most 65,535 vectors.

    Neighbours and their memberships are computed by Spark; the layout itself, of a bounded size, is a seeded gradient descent on the
    driver. It starts from two principal components or from ``init`` (``i``, ``x``, ``y``). Coordinates aren't those of other implementations."""
    spark = vectors.sparkSession
    n = vectors.count()
    if n > CEILING:
        raise ValueError(f"a layout holds at most {CEILING} vectors")
    if n < 3:
        return vectors.select(F.col(id_col).cast("long").alias("i"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    near = exact_neighbours(vectors, n_neighbors, id_col, vec_col).select("i", "j", F.greatest(1 - F.col("cos"), F.lit(0.0)).alias("d"))

    def weigh(key, pdf):
        pdf = pdf.sort_values(["d", "j"])
        return pdf.assign(w=_smooth(pdf["d"].round(9).to_numpy()).round(9))[["i", "j", "w"]]

    one_way = near.groupBy("i").applyInPandas(weigh, "i long, j long, w double")
    other = one_way.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("w").alias("back"))
    w, back = F.coalesce("w", F.lit(0.0)), F.coalesce("back", F.lit(0.0))
    edges = one_way.join(other, ["i", "j"], "full_outer").select("i", "j", (w + back - w * back).alias("w")).where("i < j").orderBy("i", "j").toPandas()
    ids = np.array([r[0] for r in vectors.select(F.col(id_col).cast("long")).orderBy(id_col).collect()])
    if init is not None:
        start = init.toPandas().set_index("i").reindex(ids)[["x", "y"]].fillna(0.0).to_numpy()
    else:
        two = pca_reduce(vectors, 2, id_col, vec_col).select(F.col(id_col).cast("long").alias("i"), F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y"))
        start = two.toPandas().set_index("i").reindex(ids)[["x", "y"]].to_numpy()
        # The signs of components are arbitrary and their last digits depend on the order of sums; neither may steer the descent.
        start = (start * np.sign(start[np.abs(start).argmax(axis=0), [0, 1]])).round(6)
    rng = np.random.default_rng(seed)
    at = start * (10 / max(np.abs(start).max(), 1e-9)) + rng.normal(scale=1e-4, size=start.shape)
    head, tail, weight = np.searchsorted(ids, edges["i"]), np.searchsorted(ids, edges["j"]), edges["w"].to_numpy() / max(edges["w"].max(), 1e-12)
    a, b = curve(min_dist)
    for epoch in range(epochs):
        rate = 1 - epoch / epochs
        drawn = rng.random(len(weight)) < weight
        h, t = head[drawn], tail[drawn]
        diff = at[h] - at[t]
        d2 = (diff * diff).sum(axis=1, keepdims=True)
        pull = np.clip(np.where(d2 > 0, -2 * a * b * d2 ** (b - 1) / (1 + a * d2**b), 0) * diff, -4, 4)
        move = np.zeros_like(at)
        np.add.at(move, h, pull)
        np.add.at(move, t, -pull)
        for _ in range(5):
            for one in (h, t):
                far = rng.integers(0, len(ids), len(one))
                diff = at[one] - at[far]
                d2 = (diff * diff).sum(axis=1, keepdims=True)
                np.add.at(move, one, np.clip(np.where(d2 > 0, 2 * b / ((0.001 + d2) * (1 + a * d2**b)), 0) * diff, -4, 4) / 2)
        at += rate * np.clip(move, -4, 4)
    return spark.createDataFrame([(int(i), float(x), float(y)) for i, (x, y) in zip(ids, at)], "i long, x double, y double")


def aligned_layout(vectors: DataFrame, reference_raw: DataFrame | None = None, reference_points: DataFrame | None = None, reference_box: DataFrame | None = None, **umap: object) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Raw layout, points, box, displacement. A member of an aligned group starts from the reference's raw layout, is laid onto
    it and shares its box; any other dataset has a box of its own and no displacement."""
    if reference_raw is None:
        raw = umap_layout(vectors, **umap)
        box = bounding_box(raw)
        return raw, fit_box(raw, box), box, None
    raw = procrustes(umap_layout(vectors, init=reference_raw, **umap), reference_raw)
    points = fit_box(raw, reference_box)
    return raw, points, reference_box, displacement(points, reference_points)


