"""Vectors of words from the sentences that they stand in: a pluggable encoder, pooled over each word's tokens and contexts.

``HashedNgrams`` is a stand-in for a neural encoder where there is none: deterministic, without any model, and not equivalent to one."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.alphabet import GEORGIAN, Alphabet

Encoder = Callable[[list[str], list[tuple[int, int]]], np.ndarray]
_TURN = 2654435761


def layer_index(layer: str | None, fraction: float | None, layers: int) -> int | None:
    """The layer to read: None for the last; else a fraction of all layers, rounded half to even, from 1 to their number."""
    if layer == "last" or fraction is None:
        return None
    return max(1, min(layers, round(fraction * layers)))


def row_seed(base: int, i: int) -> int:
    """A seed for each row of its own."""
    return base ^ (i * _TURN & 0xFFFFFFFF)


class HashedNgrams:
    """Sums of hashed directions of the letter n-grams of the word itself and, at less weight, of the words around it."""

    def __init__(self, dimensions: int = 256, around: float = 0.5, reach: int = 60) -> None:
        self.dimensions, self.around, self.reach = dimensions, around, reach

    def _add(self, out: np.ndarray, text: str, weight: float) -> None:
        for word in text.lower().split():
            marked = f"^{word}$"
            for n in (3, 4):
                for k in range(max(1, len(marked) - n + 1)):
                    h = zlib.crc32(marked[k : k + n].encode())
                    out[h % self.dimensions] += weight if h >> 31 else -weight

    def __call__(self, texts: list[str], spans: list[tuple[int, int]]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions))
        for row, text, (start, end) in zip(out, texts, spans):
            self._add(row, text[start:end], 1.0)
            self._add(row, text[max(0, start - self.reach) : start] + " " + text[end : end + self.reach], self.around)
        return out


def inputs(sampled: DataFrame, template: str = "{text}", key: str = "i", alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``key``, ``text``, ``start``, ``end`` of each sampled occurrence (``form``, ``text``) whose form its sentence holds."""
    made = sampled.withColumn("w", X.input_window(template, F.col("text"), F.col("form"), alphabet)).where("w IS NOT NULL")
    return made.select(key, "w.text", "w.start", "w.end")


def embed(contexts: DataFrame, encoder: Encoder, dimensions: int, key: str = "i") -> DataFrame:
    """``key``, ``vec``, ``n_used``: the mean of a word's context vectors at length 1.

    The encoder runs on batches within each task, which sums up what it has of each word before anything is shuffled."""
    schema = f"{key} {contexts.schema[key].dataType.simpleString()}, total array<double>, n long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.asarray(encoder(b["text"].tolist(), list(zip(b["start"].astype(int), b["end"].astype(int)))), np.float32).astype(np.float64)
            keys, at = np.unique(b[key].to_numpy(), return_inverse=True)
            sums = np.zeros((len(keys), dimensions))
            np.add.at(sums, at, v)
            yield pd.DataFrame({key: keys, "total": list(sums), "n": np.bincount(at, minlength=len(keys))})

    parts = contexts.mapInPandas(run, schema)
    counts = parts.groupBy(key).agg(F.sum("n").alias("n_used"))
    whole = V.weighted_sums(parts, key, F.lit(1.0), F.col("total"))
    return whole.join(counts, key).select(key, V.l2_normalize(F.col("total")).alias("vec"), "n_used")


def span_pooled(tokens: DataFrame, key: str = "i", row: str = "row", start: str = "start", end: str = "end") -> DataFrame:
    """``key``, ``vec``, ``n_used``: the mean, at length 1, of each word's contexts, each the mean of its tokens' vectors.

    ``tokens`` has a row for each token of each context (``row``) of a word (``key``): its place in the text (``at``, ``until``), its vector
    (``vec``), and the span of the word there (``start``, ``end``). A token counts if it overlaps the span; those without width,
    as marks of beginning and end are, never do. A context without such a token is left out."""
    inside = (F.col("until") > F.col("at")) & (F.col("at") < F.col(end)) & (F.col("until") > F.col(start))
    named = F.struct(F.col(f"`{key}`").alias("k"), F.col(f"`{row}`").alias("r"))
    each = tokens.where(inside).withColumn("__context", F.to_json(named))
    kind = f"struct<k:{tokens.schema[key].dataType.simpleString()}>"
    means = V.weighted_sums(each, "__context", F.lit(1.0), F.col("vec"))
    mean = F.transform("total", lambda x: x / F.col("weight"))
    whole = V.weighted_sums(means.select(F.from_json("__context", kind)["k"].alias(key), mean.alias("v")), key, F.lit(1.0), F.col("v"))
    return whole.select(key, V.l2_normalize(F.col("total")).alias("vec"), F.col("weight").cast("long").alias("n_used"))
