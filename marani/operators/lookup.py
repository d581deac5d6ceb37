"""Small queries over a published dataset: label search, related words, pins of new vectors, morphing between layouts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions import vectors as V

#: Rows of a block of queries or vectors.
BLOCK_ROWS = 4096


def prefix_search(vocab: DataFrame, prefix: str, limit: int = 20) -> DataFrame:
    return vocab.where(X.fold(F.col("word")).startswith(prefix.lower())).orderBy(F.desc_nulls_last("freq"), "word", "i").limit(limit)


def fuzzy_search(vocab: DataFrame, word: str, most: int = 2, limit: int = 20) -> DataFrame:
    """Words at most ``most`` edits away, the nearest first, with their ``distance``."""
    d = F.levenshtein(X.fold(F.col("word")), F.lit(word.lower()))
    return vocab.withColumn("distance", d).where(F.col("distance") <= most).orderBy("distance", F.desc_nulls_last("freq"), "word", "i").limit(limit)


def related_words(neighbours: DataFrame, vocab: DataFrame, i: int) -> DataFrame:
    return neighbours.where(F.col("i") == i).join(vocab.select(F.col("i").alias("j"), "word"), "j").orderBy("rank").select("rank", "j", "word", "sim_u8")


def nearest_to(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """``q``, ``i``, ``cos``: the k vectors (``i``, ``vec``) nearest to each stated query (``q``, ``qv``), equal cosines by the smaller id.

    The queries are cut into blocks by what a task can hold, and every block meets every part of the vectors, which keeps the k best
    of each query. So neither side is sent whole to all tasks, and there is no join of rows with rows."""
    asked = queries.select("q", F.col("qv").alias("v")).where("q IS NOT NULL AND v IS NOT NULL")
    rows = vectors.select("i", F.col("vec").alias("v")).where("i IS NOT NULL AND v IS NOT NULL")
    lines, columns = (max(1, -(-d.count() // BLOCK_ROWS)) for d in (asked, rows))
    block = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q_type, i_type = asked.schema["q"].dataType, rows.schema["i"].dataType
    left = asked.select(block("q", lines).alias("line"), every(columns).alias("column"), F.col("q"), F.lit(None).cast(i_type).alias("i"), F.col("v").cast("array<double>").alias("v"))
    right = rows.select(every(lines).alias("line"), block("i", columns).alias("column"), F.lit(None).cast(q_type).alias("q"), F.col("i"), F.col("v").cast("array<double>").alias("v"))
    schema = T.StructType([T.StructField("q", q_type), T.StructField("i", i_type), T.StructField("cos", T.DoubleType())])

    def compare(table: pa.Table) -> pa.Table:
        q, i = table.filter(pc.is_valid(table.column("q"))), table.filter(pc.is_valid(table.column("i")))
        if not len(q) or not len(i):
            return table.select(["q", "i"]).slice(0, 0).append_column("cos", pa.array([], pa.float64()))
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        cos = unit(V.matrix_of(q.column("v"))) @ unit(V.matrix_of(i.column("v"))).T
        rank = np.empty(len(i), np.int64)
        rank[np.asarray(pc.array_sort_indices(i.column("i").combine_chunks()))] = np.arange(len(i))
        few = min(k, len(i))
        rounded = np.round(cos, 9)
        edge = np.partition(rounded, len(i) - few, axis=1)[:, -few]
        row, col = np.nonzero(rounded >= edge[:, None])
        order = np.lexsort((rank[col], -rounded[row, col], row))
        row, col = row[order], col[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < few
        row, col = row[keep], col[keep]
        return pa.table({"q": q.column("q").take(pa.array(row)), "i": i.column("i").take(pa.array(col)), "cos": pa.array(cos[row, col])})

    best = left.unionByName(right).groupBy("line", "column").applyInArrow(compare, schema)
    w = Window.partitionBy("q").orderBy(F.desc(F.round("cos", 9)), "i")
    return best.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")


def pin(queries: DataFrame, vectors: DataFrame, points: DataFrame, k: int = 8, temperature: float = 0.05) -> DataFrame:
    """``q``, ``x``, ``y``: where each stated query vector (``q``, ``qv``) belongs in the layout: the mean of its k nearest words' points,
    weighted by the softmax of their cosines. Queries are compared with all vectors by blocks."""
    near = nearest_to(queries, vectors, k).join(points, "i")
    weight = F.exp((F.col("cos") - F.max("cos").over(Window.partitionBy("q"))) / temperature)
    near = near.withColumn("w", weight)
    return near.groupBy("q").agg(*((F.sum(F.col("w") * F.col(c)) / F.sum("w")).alias(c) for c in "xy"))


def morph(start: DataFrame, end: DataFrame, t: float) -> DataFrame:
    """Points between two layouts of one index at time t from 0 to 1, with cubic easing at both ends."""
    e = 4 * t**3 if t < 0.5 else 1 - (-2 * t + 2) ** 3 / 2
    b = end.select("i", F.col("x").alias("u"), F.col("y").alias("v"))
    return start.join(b, "i").select("i", (F.col("x") + (F.col("u") - F.col("x")) * e).alias("x"), (F.col("y") + (F.col("v") - F.col("y")) * e).alias("y"))
