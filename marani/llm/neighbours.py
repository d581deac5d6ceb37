"""The most similar vectors of every vector (problem 4): multiprobe hashing with p-stable projections.

Each of ``TABLES`` tables hashes a vector by floor((a.v + b) / w) for several random directions a. A vector is stored in one
bucket of each table and looks into that bucket and ``PROBES`` perturbed ones, in the order in which they are likely to hold
its neighbours: the perturbations are taken by the vector's distances to the borders of its cells, in the order that is
expected of sorted distances. What a bucket holds and what looks into it are compared exactly, by matrix products, and both
sides keep their best; the candidates of all buckets and tables are merged and ranked by exact cosine, ties by the smaller id.

The numbers of directions are fitted on a sample of ``SAMPLE`` vectors: so many that a bucket holds a few times the square root of
the collection, and no more than ``BUCKET_ROWS``; with more directions more buckets are probed. Buckets that share the cells of
the first directions form a group, of about ``GROUP_ROWS`` vectors. A vector travels once to each group that it is stored in or
looks into, with the list of the buckets there, and not once to each bucket. A group that is larger all the same is cut into a
grid of blocks, each compared with each, so that none of its pairs is lost and no task holds it whole. Of equal vectors only as
many are searched as can be among another's best.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle

TABLES, PROBES, WIDTH, SAMPLE = 2, 8, 2.0, 20_000
#: Directions up to which PROBES are enough to find 99 of 100; two more ask for twice as many.
PROBED_DIRECTIONS = 6
#: A bucket holds so many times the square root of the collection, and at most so many rows, on average.
ROOTS, BUCKET_ROWS = 4, 3_000
#: Vectors that a group holds, by the sample, and rows beyond which it is cut into blocks of so many.
GROUP_ROWS, LARGEST_GROUP = 30_000, 100_000
ROWS_PER_BATCH, SEEKERS_AT_ONCE = 2_000, 512
#: Similarities of single precision this close may be equal; pairs whose similarity is computed anew at once.
ROUNDING, PAIRS = 2e-6, 100_000


def perturbations(directions: int, count: int) -> list[tuple[int, ...]]:
    """Sets of ranks (0 for the nearest border of all) by the sum of their expected squared distances, the least first.

    Ranks r and 2 * directions - 1 - r belong to the two borders of one cell and never stand in one set."""
    m = directions
    expected = [r * (r + 1) / (4 * (m + 1) * (m + 2)) for r in range(1, m + 1)]
    expected += [1 - (2 * m + 1 - r) / (m + 1) + (2 * m + 1 - r) * (2 * m + 2 - r) / (4 * (m + 1) * (m + 2)) for r in range(m + 1, 2 * m + 1)]
    heap, out = [(expected[0], (0,))], []
    while heap and len(out) < count:
        total, ranks = heapq.heappop(heap)
        if not any(2 * m - 1 - r in ranks for r in ranks):
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total + expected[last + 1] - expected[last], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (total + expected[last + 1], (*ranks, last + 1)))
    return out


@dataclass
class Hashing:
    directions: np.ndarray  # table x dimension x direction
    shift: np.ndarray  # table x direction
    multiplier: np.ndarray  # table x direction: a bucket's number is the sum of its cells, each times this
    width: float
    probes: int
    first: int = 1  # directions that make a group

    def buckets(self, v: np.ndarray, table: int, probes: bool) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of each vector and, with ``probes``, those that it looks into besides; and the group of each of these."""
        a, mult = self.directions[table], self.multiplier[table]
        place = (v @ a + self.shift[table]) / self.width
        cell = np.floor(place)
        parts = cell.astype(np.int64) * mult
        own, group = parts.sum(axis=1), parts[:, : self.first].sum(axis=1)
        if not probes:
            return own[:, None], group[:, None]
        low = place - cell
        order = np.argsort(np.concatenate([low, 1 - low], axis=1), axis=1, kind="stable")
        change = np.concatenate([-mult, mult])
        of_group = np.where(np.arange(2 * len(mult)) % len(mult) < self.first, change, 0)
        change, of_group = change[order], of_group[order]
        sets = [list(s) for s in perturbations(a.shape[1], self.probes)]
        return tuple(np.stack([x, *(x + c[:, s].sum(axis=1) for s in sets)], axis=1) for x, c in ((own, change), (group, of_group)))


def _draw(dimensions: int, directions: int, tables: int, width: float, probes: int, seed: int) -> Hashing:
    rng = np.random.default_rng([seed, directions])
    return Hashing(
        rng.normal(size=(tables, dimensions, directions)).astype(np.float32),
        rng.uniform(0, width, (tables, directions)).astype(np.float32),
        rng.integers(1, 1 << 62, (tables, directions), dtype=np.int64) | 1,
        width,
        probes,
    )


def fit(sample: np.ndarray, count: int, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, seed: int = 4) -> Hashing:
    """The least number of directions by which a vector shares its bucket with no more than wanted of ``count`` vectors, and
    the least number of the first of them by which no group of the sample stands for more than ``GROUP_ROWS``."""
    want = min(ROOTS * math.sqrt(count), BUCKET_ROWS)
    for m in range(2, 49):
        hashing = _draw(sample.shape[1], m, tables, width, round(probes * max(1.0, 2 ** ((m - PROBED_DIRECTIONS) / 2))), seed)
        if len(sample) < 2:
            return hashing
        shared = 0.0
        for t in range(tables):
            _, size = np.unique(hashing.buckets(sample, t, False)[0], return_counts=True)
            shared += (size * (size - 1.0)).sum() / (len(sample) * (len(sample) - 1.0)) / tables
        if shared * count <= want:
            break
    for hashing.first in range(1, m + 1):
        largest = max(np.unique(hashing.buckets(sample, t, False)[1], return_counts=True)[1].max() for t in range(tables))
        if largest * count <= GROUP_ROWS * len(sample):
            break
    return hashing


def usable(df: DataFrame, id_col: str, vec_col: str, dimensions: int) -> DataFrame:
    """``i`` and ``v`` (unit length, as bytes), once for each id: of an id's rows the least vector of all that can be used.

    Vectors that are null, of another length, all zero, or hold a null or a value that isn't finite are left out, as are null ids."""
    vec = F.col(f"`{vec_col}`")
    good = (
        df.select(F.col(f"`{id_col}`").cast("long").alias("i"), vec.cast("array<float>").alias("v"))
        .where(F.col("i").isNotNull() & (F.size("v") == dimensions))
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0))
    )

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = np.asarray(b.column(1).flatten(), np.float64).reshape(b.num_rows, dimensions)
            v = v / np.abs(v).max(axis=1, keepdims=True)
            v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype("<f4")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in v], pa.binary())], names=["i", "v"])

    return good.mapInArrow(unit, "i long, v binary").groupBy("i").agg(F.min("v").alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, dimensions)


def _cut(ids: np.ndarray, row: np.ndarray, other: np.ndarray, cos: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best pairs of each row, equal similarities by the smaller id."""
    order = np.lexsort((ids[other], -cos, row))
    row, other, cos = row[order], other[order], cos[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], other[keep], cos[keep]


def _best(ids: np.ndarray, v: np.ndarray, row: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cos = [np.einsum("ij,ij->i", v[row[n : n + PAIRS]], v[other[n : n + PAIRS]], dtype=np.float64) for n in range(0, len(row), PAIRS)]
    return _cut(ids, row, other, np.round(np.concatenate([np.empty(0), *cos]), 12), k)


def _lists(ids: np.ndarray, row: np.ndarray, other: np.ndarray, cos: np.ndarray) -> pa.Table:
    """One row for each row that has pairs, which stand together."""
    start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    ends = pa.array(np.r_[start, len(row)].astype(np.int32))
    return pa.table({"i": pa.array(ids[row[start]]), "j": pa.ListArray.from_arrays(ends, pa.array(ids[other])), "far": pa.ListArray.from_arrays(ends, pa.array(-cos))})


def _leading(row: np.ndarray, other: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs, each once, whose similarity is within rounding of the row's k-th best or better."""
    order = np.argsort(row << 32 | other)
    row, other, sim = row[order], other[order], sim[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (other[1:] != other[:-1])] if len(row) else np.empty(0, bool)
    row, other, sim = row[new], other[new], sim[new]
    far = ((1.001 - sim.astype(np.float64)) * (1 << 30)).astype(np.int64)  # a whole number, so that one key sorts by row and similarity
    order = np.argsort(row << 32 | far)
    row, other, sim, far = row[order], other[order], sim[order], far[order]
    start = np.searchsorted(row, row)
    last = np.minimum(start + k, np.searchsorted(row, row, "right")) - 1
    keep = far <= far[last] + int(ROUNDING * (1 << 30))
    return row[keep], other[keep], sim[keep]


class Search:
    """The comparison of one block: what is stored in its buckets with what looks into them."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int) -> None:
        self.ids, self.v, self.k = ids, v, k
        self.edge = np.full(len(ids), -np.inf, np.float32)  # no more than the similarity of each row's k-th best
        self.pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _side(self, sim: np.ndarray, rows: np.ndarray, others: np.ndarray) -> None:
        """Pairs whose similarity is within rounding of the row's k-th best or better."""
        new = np.flatnonzero(np.isneginf(self.edge[rows]))
        if len(new) and len(others) > self.k:
            part = sim if len(new) == len(rows) else sim[new]
            self.edge[rows[new]] = np.partition(part, part.shape[1] - self.k, axis=1)[:, -self.k]
        row, col = np.nonzero(sim >= np.maximum(self.edge[rows] - ROUNDING, -8)[:, None])
        found = rows[row], others[col], sim[row, col]
        # Where many are as similar as the k-th best only the best of them stay.
        if len(row) > len(rows) * 8 * self.k:
            found = _leading(*found, self.k)
            if len(found[0]) > len(rows) * 8 * self.k:
                row, other, cos = _best(self.ids, self.v, *found[:2], self.k)
                found = row, other, cos.astype(np.float32)
        self.pairs.append(found)

    def compare(self, seekers: np.ndarray, members: np.ndarray, both: bool) -> None:
        """``members`` in the order of their ids. Unless ``both``, only the seekers learn of the members."""
        own = self.ids[members]
        for n in range(0, len(seekers), SEEKERS_AT_ONCE):
            part = seekers[n : n + SEEKERS_AT_ONCE]
            sim = self.v[part] @ self.v[members].T
            at = np.minimum(np.searchsorted(own, self.ids[part]), len(own) - 1)
            itself = np.flatnonzero(own[at] == self.ids[part])
            sim[itself, at[itself]] = -9
            self._side(sim, part, members)
            if both:
                self._side(np.ascontiguousarray(sim.T), members, part)

    def result(self) -> pa.Table:
        row, other, sim = (np.concatenate([*x]) for x in zip((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)), *self.pairs))
        good = sim >= self.edge[row] - ROUNDING
        _, first, same = np.unique(self.ids, return_index=True, return_inverse=True)  # a block of a grid may hold a row twice
        row, other, _ = _leading(first[same[row[good]]], first[same[other[good]]], sim[good], self.k)
        return _lists(self.ids, *_best(self.ids, self.v, row, other, self.k))


def compare(block: pa.Table, k: int, dimensions: int) -> pa.Table:
    """The k best of each row of a block, by the buckets that rows are stored in and look into."""
    ids, stored, bucket = (np.asarray(block.column(c)) for c in ("i", "stored", "own"))
    search = Search(ids, _matrix(block.column("v"), dimensions), k)
    members = np.flatnonzero(stored)
    members = members[np.lexsort((ids[members], bucket[members]))]
    looks = block.column("looks").combine_chunks()
    seeker = np.repeat(np.arange(len(ids)), np.diff(np.asarray(looks.offsets)))
    into = np.asarray(looks.flatten())
    order = np.argsort(into, kind="stable")
    seeker, into = seeker[order], into[order]
    names, start = np.unique(bucket[members], return_index=True)
    places = list(zip(np.searchsorted(into, names, "left"), np.searchsorted(into, names, "right"), start, np.r_[start[1:], len(members)]))
    at_home = bucket[seeker] == into
    for own in (True, False):  # each row's own bucket first, which gives it a k-th best
        for low, high, a, b in places:
            rows = seeker[low:high][at_home[low:high] == own]
            if len(rows):
                search.compare(rows, members[a:b], both=not own)
    return search.result()


def nearest(df: DataFrame, k: int = 5, id_col: str = "i", vec_col: str = "vec128", dimensions: int = 128, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``i``, ``j``, ``sim``, ``rank``: up to k most similar vectors of each vector, rank 1 the most similar, ties by the smaller id.

    Every usable vector is both a query and indexed. Empty tables and collections of one vector give an empty result."""
    spark = df.sparkSession
    vectors = settle(usable(df, id_col, vec_col, dimensions), "vectors")
    # Of equal vectors the k + 1 with the smallest ids are searched; for the others the k smallest are the answer.
    keys = vectors.select("i", F.xxhash64("v").alias("h1"), F.xxhash64("v", F.lit(1)).alias("h2"))
    many = settle(keys.groupBy("h1", "h2").count().where(F.col("count") > k + 1).select("h1", "h2"), "many")
    searched, equal = vectors, None
    if not many.isEmpty():
        of_many = settle(keys.join(many, ["h1", "h2"]), "equal")
        few = of_many.withColumn("r", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("i"))).where(F.col("r") <= k + 1)
        few = settle(few, "few")
        equal = of_many.join(few.select("i"), "i", "left_anti")
        searched = settle(vectors.join(equal.select("i"), "i", "left_anti"), "searched")
    rows = searched.select("i", "v")
    count = rows.count()
    sample = _matrix(rows.orderBy(F.xxhash64("i"), "i").limit(SAMPLE).select("v").toArrow().column(0), dimensions)
    sent = spark.sparkContext.broadcast(fit(sample, count, tables, probes))

    def place(batches: Iterator[pa.RecordBatch], whole_rows: bool) -> Iterator[pa.RecordBatch]:
        hashing = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                v = _matrix(b.column(1), dimensions)
                for t in range(tables):
                    bucket, group = hashing.buckets(v, t, True)
                    row = np.repeat(np.arange(len(v)), bucket.shape[1])
                    into, of = (bucket >> 32).astype(np.int32).ravel(), group.ravel()
                    order = np.lexsort((of, row))
                    new = np.flatnonzero(np.r_[True, (row[order][1:] != row[order][:-1]) | (of[order][1:] != of[order][:-1])])
                    # A row for each group that a vector is stored in or looks into, with its buckets there.
                    each = row[order[new]]
                    keys = [pa.array(np.full(len(new), t, np.int32)), pa.array(of[order[new]])]
                    if not whole_rows:
                        yield pa.RecordBatch.from_arrays(keys, names=["t", "g"])
                        continue
                    looks = pa.ListArray.from_arrays(pa.array(np.r_[new, len(order)].astype(np.int32)), pa.array(into[order]))
                    take = pa.array(each)
                    rest = [pa.array(of[order[new]] == group[each, 0]), b.column(0).take(take), b.column(1).take(take), pa.array((bucket[each, 0] >> 32).astype(np.int32)), looks]
                    yield pa.RecordBatch.from_arrays([*keys, *rest], names=["t", "g", "stored", "i", "v", "own", "looks"])

    sizes = rows.mapInArrow(lambda b: place(b, False), "t int, g long").groupBy("t", "g").count()
    large = settle(sizes.where(F.col("count") > LARGEST_GROUP).select("t", "g", F.ceil(F.col("count") / LARGEST_GROUP).cast("int").alias("cuts")), "large")
    placed = rows.mapInArrow(lambda b: place(b, True), "t int, g long, stored boolean, i long, v binary, own int, looks array<int>")
    columns = ["stored", "i", "v", "own", "looks"]
    if large.isEmpty():
        cut = placed.select("t", "g", F.lit(0).alias("row"), F.lit(0).alias("col"), *columns)
    else:
        part = F.pmod(F.xxhash64("i"), F.col("cuts")).cast("int")
        all_cuts = F.sequence(F.lit(0), F.col("cuts") - 1)
        known = placed.join(F.broadcast(large), ["t", "g"], "left")  # at most all rows / LARGEST_GROUP groups
        # The blocks of a grid: a row looks in those of its line and is stored in those of its column, both in one row where they meet.
        block = lambda row, col, stored, looks: F.struct(row.alias("row"), col.alias("col"), stored.alias("stored"), looks.alias("looks"))
        nothing = F.array().cast("array<int>")
        looking = F.transform(all_cuts, lambda c: block(part, c, F.col("stored") & (c == part), F.col("looks")))
        lying = F.transform(F.filter(all_cuts, lambda c: F.col("stored") & (c != part)), lambda c: block(c, part, F.lit(True), nothing))
        alone = F.array(block(F.lit(0), F.lit(0), F.col("stored"), F.col("looks")))
        blocks = F.when(F.col("cuts").isNull(), alone).otherwise(F.concat(looking, lying))
        cut = known.select("t", "g", "i", "v", "own", F.explode(blocks).alias("b")).select("t", "g", "b.row", "b.col", "b.stored", "i", "v", "own", "b.looks")

    found = cut.groupBy("t", "g", "row", "col").applyInArrow(lambda block: compare(block, k, dimensions), "i long, j array<long>, far array<double>")
    # A pair may come from several groups; of its distances the first stays.
    none = F.array().cast("array<struct<far:double,j:bigint>>")
    first_k = lambda all_: F.aggregate(all_, none, lambda kept, x: F.when((F.size(kept) >= k) | F.exists(kept, lambda y: y["j"] == x["j"]), kept).otherwise(F.concat(kept, F.array(x))))
    merged = found.groupBy("i").agg(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("far", "j")))).alias("all")).select("i", first_k(F.col("all")).alias("best"))
    merged = merged.select("i", F.posexplode("best").alias("p", "x")).select("i", F.col("x.j").alias("j"), (-F.col("x.far")).cast("float").alias("sim"), (F.col("p") + 1).alias("rank"))
    if equal is None:
        return merged
    first = few.where(F.col("r") <= k).select("h1", "h2", F.col("i").alias("j"), F.col("r").alias("rank"))
    return merged.unionByName(equal.join(first, ["h1", "h2"]).select("i", "j", F.lit(1.0).cast("float").alias("sim"), "rank"))


def neighbour_pairs(df: DataFrame, k: int = 5, id_col: str = "i", vec_col: str = "vec128", dimensions: int = 128) -> DataFrame:
    """``i_a``, ``i_b``, i_a < i_b: each pair of which at least one is among the k most similar of the other, once."""
    best = nearest(df, k, id_col, vec_col, dimensions)
    return best.select(F.least("i", "j").cast("int").alias("i_a"), F.greatest("i", "j").cast("int").alias("i_b")).distinct()
