"""The data-quality gate: each check is a query that gives the rows that break it, as ``check``, ``detail``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

MAX_BYTES, MAX_DISPLACEMENT, CEILING = 30_000_000, 0.35, 65_535


def _rows(df: DataFrame, check: str, bad: Column, detail: Column) -> DataFrame:
    return df.where(F.coalesce(bad, F.lit(True))).select(F.lit(check).alias("check"), detail.cast("string").alias("detail"))


def count_is(df: DataFrame, count: int, check: str = "label_count") -> DataFrame:
    return _rows(df.agg(F.count(F.lit(1)).alias("n")), check, F.col("n") != count, F.col("n"))


def equal_counts(a: DataFrame, b: DataFrame, check: str = "equal_counts") -> DataFrame:
    n = a.agg(F.count(F.lit(1)).alias("a")).crossJoin(b.agg(F.count(F.lit(1)).alias("b")))
    return _rows(n, check, F.col("a") != F.col("b"), F.concat_ws("/", "a", "b"))


def at_most(df: DataFrame, most: int = CEILING, check: str = "vocabulary_ceiling") -> DataFrame:
    return _rows(df.agg(F.count(F.lit(1)).alias("n")), check, F.col("n") > most, F.col("n"))


def file_sizes(files: DataFrame, want: dict[str, int]) -> DataFrame:
    """``files`` has name and length; a file of another size, or none, breaks the check."""
    asked = files.sparkSession.createDataFrame(list(want.items()), "name string, want long")
    return _rows(asked.join(files.select("name", "length"), "name", "left"), "file_size", F.col("length") != F.col("want"), F.col("name"))


def finite(df: DataFrame, *cols: str) -> DataFrame:
    """Numbers, or lists of numbers, that are null, not a number or infinite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kinds = dict(df.dtypes)
    parts = [_rows(df, "finite", F.exists(c, bad) if kinds[c].startswith("array") else bad(F.col(c)), F.concat_ws(":", F.lit(c), F.col("i").cast("string"))) for c in cols]
    return reduce(DataFrame.unionByName, parts)


def neighbours_in_range(neighbours: DataFrame, count: int) -> DataFrame:
    return _rows(neighbours, "neighbour_range", ~F.col("j").between(0, count - 1), F.concat_ws(":", "i", "j"))


def no_listed_words(vocab: DataFrame, words: DataFrame) -> DataFrame:
    folded = words.select(X.fold(F.col(words.columns[0])).alias("__w")).distinct()
    return vocab.join(folded, X.fold(F.col("word")) == F.col("__w"), "left_semi").select(F.lit("listed_word").alias("check"), F.col("word").alias("detail"))


def displacement_below(datasets: DataFrame, most: float = MAX_DISPLACEMENT) -> DataFrame:
    """``datasets`` has id, aligned_group, reference, median; only members that aren't the reference count."""
    members = datasets.where("aligned_group IS NOT NULL AND NOT reference")
    return _rows(members, "displacement", F.col("median") >= most, F.col("id"))


def one_hash_per_group(datasets: DataFrame) -> DataFrame:
    n = datasets.where("aligned_group IS NOT NULL").groupBy("aligned_group").agg(F.count_distinct("vocab_hash").alias("n"))
    return _rows(n, "vocab_hash", F.col("n") > 1, F.col("aligned_group"))


def total_size(files: DataFrame, most: int = MAX_BYTES) -> DataFrame:
    return _rows(files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")), "total_size", F.col("n") > most, F.col("n"))


def probes_pass(metrics: DataFrame, least: float = 0.7) -> DataFrame:
    """Too few hits break the check, unless no probe is present, and so does any forbidden neighbour."""
    return _rows(metrics, "probes", ((F.col("present") > 0) & (F.col("hit_rate") < least)) | (F.col("forbidden") > 0), F.col("hit_rate"))


def covered(coverage: DataFrame) -> DataFrame:
    return _rows(coverage, "coverage", ~F.col("enough"), F.col("part"))


def gate(*checks: DataFrame) -> DataFrame:
    """All failures of all checks; the gate is passed if there is none."""
    return reduce(DataFrame.unionByName, checks)
