"""Vector functions on ARRAY columns, in double precision throughout."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with a value that is worked out once, and not again for each element of an array that the body goes through."""
    return F.element_at(F.transform(F.array(value), body), 1)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v.cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column) -> Column:
    """A vector of length 1; a zero vector stays as it is."""
    n = norm(v)
    return bound(F.when(n == 0, F.lit(1.0)).otherwise(n), lambda n: F.transform(v.cast("array<double>"), lambda x: x / n))


def prefix_reduce(v: Column, dimensions: int = 128) -> Column:
    """The first dimensions, at length 1 again. Only for vectors whose model is trained for it."""
    return l2_normalize(F.slice(v, 1, dimensions))


def cosine_u8(cosine: Column) -> Column:
    """A cosine from 0 to 1 as a number from 0 to 255, halves to even."""
    return F.rint(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(0.0)) * 255).cast("smallint")


def quantize_i8(v: Column) -> Column:
    """STRUCT<q ARRAY<TINYINT>, scale DOUBLE>: symmetric per vector; a zero vector has scale 1."""
    d = v.cast("array<double>")
    largest = F.array_max(F.transform(d, F.abs)) / 127

    def quantized(scale: Column) -> Column:
        q = F.transform(d, lambda x: F.greatest(F.least(F.rint(x / scale), F.lit(127.0)), F.lit(-127.0)).cast("tinyint"))
        return F.struct(q.alias("q"), scale.alias("scale"))

    return bound(F.when(largest == 0, F.lit(1.0)).otherwise(largest), quantized)


def int8_cosine(a: Column, b: Column) -> Column:
    """The cosine of two quantised vectors of length 1, with an error of about a hundredth."""
    return dot(a["q"], b["q"]) * a["scale"] * b["scale"]


def combine(terms: list[tuple[float, Column]]) -> Column:
    """A sum of vectors, each times a number."""

    def times(v: Column, w: float) -> Column:
        return F.transform(v.cast("array<double>"), lambda x: x * w)

    out = None
    for w, v in terms:
        part = times(v, w)
        out = part if out is None else F.zip_with(out, part, lambda x, y: x + y)
    return out


def matrix_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a list column as a matrix of double precision; all lists must be of one length and without nulls."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)


def weighted_sums(df: DataFrame, key: str, weight: Column, vec: Column) -> DataFrame:
    """``key``, ``total ARRAY<DOUBLE>``, ``weight``: the sums of each key's vectors times their weights, and of the weights.

    Each batch of a task is added up first, so that of a key that many rows have one row a batch is shuffled. A vector travels
    whole, not as a row for each dimension. Rows whose key, weight or vector is null are left out; all vectors must be of
    one length."""
    rows = df.select(F.col(f"`{key}`").alias("k"), weight.cast("double").alias("w"), vec.cast("array<double>").alias("v")).where("k IS NOT NULL AND w IS NOT NULL AND v IS NOT NULL")
    schema = T.StructType([rows.schema["k"], T.StructField("w", T.DoubleType()), T.StructField("v", T.ArrayType(T.DoubleType()))])

    def sums(key_column: pa.Array, w: np.ndarray, v: np.ndarray) -> list[pa.Array]:
        coded = key_column.dictionary_encode()
        at = np.asarray(coded.indices)
        order = np.argsort(at, kind="stable")
        start = np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])
        total = np.add.reduceat(v[order], start, axis=0)
        offsets = pa.array(np.arange(len(start) + 1, dtype=np.int32) * v.shape[1])
        return [coded.dictionary.take(pa.array(at[order][start])), pa.array(np.add.reduceat(w[order], start)), pa.ListArray.from_arrays(offsets, pa.array(total.ravel()))]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                w = np.asarray(b.column(1))
                yield pa.RecordBatch.from_arrays(sums(b.column(0), w, matrix_of(b.column(2)) * w[:, None]), names=["k", "w", "v"])

    def between(block: pa.Table) -> pa.Table:
        column = block.column("k").combine_chunks()
        return pa.Table.from_arrays(sums(column, np.asarray(block.column("w")), matrix_of(block.column("v"))), names=["k", "w", "v"])

    partial = rows.mapInArrow(within, schema)
    return partial.groupBy("k").applyInArrow(between, schema).select(F.col("k").alias(key), F.col("v").alias("total"), F.col("w").alias("weight"))
