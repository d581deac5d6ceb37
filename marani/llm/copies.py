"""Duplicates hidden by formatting differences (problem 5).

Sentences are the same if they have the same words and numbers in the same order, whatever their white space, letter case and
punctuation; record sentences (``label: value`` fields with one separator throughout) also if they have the same fields in any order.
Each sentence gets a key of its words, and a record one of its fields, of which two 64-bit hashes each travel. Rows with one
key of words are put together first, then keys of words that share a key of fields. Keys of words that many rows hold are found
exactly: every partition sends a bounded summary of partial counts (Misra and Gries), of which the sum, with the summaries'
known error, leaves no heavy key out, and the few that are left are counted exactly. Heavy keys are aggregated in two levels
over salted groups, all others in one shuffle. The representative of each is the row with the smallest identifier.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import settle, spread
from .words import IGNORABLE

#: A key is heavy with so many rows, which one task takes easily. There are at most MOST_HEAVY such keys: with more than
#: ROWS_OF_A_KEY x MOST_HEAVY rows in all, a key needs that part of them to be heavy.
ROWS_OF_A_KEY, MOST_HEAVY, SALTS = 100_000, 1_000_000, 64
# What may stand between the fields of a record, in the order in which it is tried, and between label and value.
SEPARATORS, EQUALS = [";", "|", "•", "\n", ","], ":=–"
_word = r"[\p{L}\p{N}]"


def words_only(text: Column) -> Column:
    """Words and numbers in lower case with one space between them."""
    return F.btrim(F.regexp_replace(F.lower(F.upper(F.regexp_replace(text, f"[{IGNORABLE}]+", ""))), r"[^\p{L}\p{M}\p{N}]+", " "))


def fields_of(text: Column) -> Column:
    """The canonical form of a record: its fields in order. Null for all other texts."""
    bare = F.regexp_replace(text, r"[\s.!?…;,|•]+$", "")
    label = rf"^[^{EQUALS}]*{_word}[^{EQUALS}]*[{EQUALS}][\s\S]*{_word}"
    tries = []
    for s in SEPARATORS:
        fields = F.filter(F.split(bare, f"[{s}]"), lambda x: x.rlike(_word))
        record = (F.size(fields) >= 2) & F.forall(fields, lambda x: x.rlike(label))
        each = F.transform(fields, lambda x: F.concat(words_only(F.regexp_extract(x, rf"^[^{EQUALS}]*", 0)), F.lit("="), words_only(F.regexp_replace(x, rf"^[^{EQUALS}]*[{EQUALS}]", ""))))
        tries.append(F.when(record, F.concat(F.lit(";"), F.array_join(F.array_sort(each), ";"))))
    return F.when(text.rlike(_word) & text.rlike(f"[{EQUALS}]"), F.coalesce(*tries))


def keyed(df: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``id``, the key of the words (``h1``, ``h2``) and of the fields (``fields``, null unless it is a record) of each row whose text holds a letter or digit."""
    rows = spread(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")))
    form = rows.where(F.col("text").rlike(_word)).select("id", words_only(F.col("text")).alias("words"), fields_of(F.col("text")).alias("form"))
    fields = F.when(F.col("form").isNotNull(), F.struct(F.xxhash64("form").alias("h1"), F.xxhash64("form", F.lit(5)).alias("h2")))
    return form.select("id", F.xxhash64("words").alias("h1"), F.xxhash64("words", F.lit(5)).alias("h2"), fields.alias("fields"))


def heavy_keys(rows: DataFrame, least_rows: int | None = None) -> DataFrame | None:
    """``h1``, ``h2``, ``count`` of exactly the keys with at least ``least_rows`` rows (ROWS_OF_A_KEY) and 1 / MOST_HEAVY of all; None if there are none."""
    total = rows.count()
    least = max(ROWS_OF_A_KEY if least_rows is None else least_rows, total // MOST_HEAVY, 1)
    if total < least:
        return None
    size = math.ceil(4 * total / least)  # keys in a summary, 4 * MOST_HEAVY at most; all summaries together lose less than total / size, so a quarter of ``least``

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, lost = np.empty(0, np.dtype("i8,i8")), np.empty(0, np.int64), 0
        for b in batches:
            new = np.empty(b.num_rows, key.dtype)
            new["f0"], new["f1"] = np.asarray(b.column(0)), np.asarray(b.column(1))
            key, at = np.unique(np.concatenate([key, new]), return_inverse=True)
            count = np.bincount(at, np.concatenate([count, np.ones(len(new), np.int64)]), len(key)).astype(np.int64)
            if len(count) > size:
                cut = int(np.partition(count, -size - 1)[-size - 1])
                lost += cut
                key, count = key[count > cut], count[count > cut] - cut
        out = [np.r_[key["f0"], 0], np.r_[key["f1"], 0], np.r_[count, lost], np.r_[np.zeros(len(key), bool), True]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["h1", "h2", "n", "error"])

    sums = rows.select("h1", "h2").mapInArrow(summary, "h1 long, h2 long, n long, error boolean").groupBy("h1", "h2", "error").agg(F.sum("n").alias("n"))
    sums = settle(sums, "summary")
    error = sums.where("error").agg(F.sum("n")).first()[0] or 0
    likely = sums.where(~F.col("error") & (F.col("n") + error >= least)).select("h1", "h2")  # at most 4 / (3 * part) keys
    exact = rows.join(F.broadcast(likely), ["h1", "h2"]).groupBy("h1", "h2").count().where(F.col("count") >= least)
    found = settle(exact, "heavy")
    return None if found.isEmpty() else found


def groups(rows: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """``h1``, ``h2``, ``first_id``, ``copies`` of each key of words, with the first and the last key of fields that its rows have (``low``, ``high``)."""
    each = [F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.min("fields").alias("low"), F.max("fields").alias("high")]
    if heavy is None:
        return rows.groupBy("h1", "h2").agg(*each)
    few = F.broadcast(heavy.select("h1", "h2"))
    light = rows.join(few, ["h1", "h2"], "left_anti").groupBy("h1", "h2").agg(*each)
    salted = rows.join(few, ["h1", "h2"]).groupBy("h1", "h2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(*each)
    both = [F.min("first_id").alias("first_id"), F.sum("copies").alias("copies"), F.min("low").alias("low"), F.max("high").alias("high")]
    return light.unionByName(salted.groupBy("h1", "h2").agg(*both))


def _linked(links: DataFrame) -> DataFrame:
    """``fields``, ``root``: the least key of fields that each is linked with, over any number of links (``low``, ``fields``)."""
    both = settle(links.unionByName(links.select(F.col("fields").alias("low"), F.col("low").alias("fields"))).distinct(), "links")
    roots = settle(both.groupBy("fields").agg(F.least(F.col("fields"), F.min("low")).alias("root")), "roots")
    while True:
        seen = both.join(roots.select(F.col("fields").alias("low"), F.col("root").alias("r")), "low").groupBy("fields").agg(F.min("r").alias("r"))
        nearer = settle(roots.join(seen, "fields").select("fields", F.least("root", "r").alias("root"), (F.col("r") < F.col("root")).alias("new")), "roots")
        roots = nearer.select("fields", "root")
        if nearer.where("new").isEmpty():
            return roots


def classes(rows: DataFrame, heavy: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The keys of words with the ``key`` of their class, and ``key``, ``first_id``, ``copies`` of each class.

    A class has the key of its fields if one of its rows is a record, else that of its words. One wording that is read as several
    records links their classes."""
    of_words = settle(groups(rows, heavy), "words")
    key = F.coalesce("low", F.struct("h1", "h2"))
    doubtful = settle(of_words.where("low < high").select("h1", "h2", "low"), "doubtful")
    if doubtful.isEmpty():
        named = of_words.withColumn("key", key)
    else:
        links = rows.where("fields IS NOT NULL").select("h1", "h2", "fields").distinct().join(doubtful, ["h1", "h2"]).where("low < fields").select("low", "fields")
        roots = _linked(links)
        named = of_words.join(roots.withColumnRenamed("fields", "low"), "low", "left").withColumn("key", F.coalesce(F.col("root"), key))
    return named.select("h1", "h2", "key", "first_id", "copies"), named.groupBy("key").agg(F.min("first_id").alias("first_id"), F.sum("copies").alias("copies"))


def collapse(df: DataFrame, id_col: str = "id", text_col: str = "text", least_rows: int | None = None) -> DataFrame:
    """``first_id``, ``copies``: one row for each sentence, with the number of rows that are the same.

    Texts that are null or hold no letter or digit have no row. Null ids count as copies but never represent; a sentence of
    which all ids are null has a null ``first_id``. Repeated rows count each. Other columns aren't read."""
    rows = settle(keyed(df, id_col, text_col), "keys")
    return classes(rows, heavy_keys(rows, least_rows))[1].select("first_id", "copies")


def repeats(df: DataFrame, id_col: str = "id", text_col: str = "text", least_rows: int | None = None) -> DataFrame:
    """``first_id``, ``id``: each row that repeats another one, with the smallest id among the same. Rows with null ids give none."""
    rows = settle(keyed(df, id_col, text_col), "keys")
    heavy = heavy_keys(rows, least_rows)
    of_words, all_ = classes(rows, heavy)
    several = all_.where("copies > 1 AND first_id IS NOT NULL").select("key", F.col("first_id").alias("first"))
    firsts = settle(of_words.select("h1", "h2", "key").join(several, "key").select("h1", "h2", F.col("first").alias("first_id")), "firsts")
    own, keys = rows.select("h1", "h2", "id"), ["h1", "h2"]
    if heavy is None:
        found = own.join(firsts, keys)
    else:
        few = F.broadcast(heavy.select(*keys))  # at most MOST_HEAVY keys
        found = own.join(few, keys, "left_anti").join(firsts, keys).unionByName(own.join(F.broadcast(firsts.join(few, keys)), keys))
    return found.where("first_id < id").select("first_id", "id")
