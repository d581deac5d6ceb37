"""The pN_ queries of the operators for training data, with their production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import copies, encode, leaks, lookalike, neighbours, sample, subjects


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


SAMPLE_SIZE, SAMPLE_SEED = 10_000, 20260704


def p1_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The occurrences that the vocabulary holds are all among those that arrive in pieces, which are the population."""
    return sample.sample(_table(spark, folder, "occurrences"), SAMPLE_SIZE, ["sid", "pos"], ["piece", "arrived_at"], ["lemma", "form"], SAMPLE_SEED)


def _looks(spark: SparkSession, folder: str) -> DataFrame:
    words = _table(spark, folder, "vocab").select(F.lit("word").alias("field"), F.col("i").cast("long").alias("key"), F.col("word").alias("text"))
    lists = _table(spark, folder, "emoji_keywords").select(F.lit("keywords_ka").alias("field"), F.col("row_id").alias("key"), F.col("keywords_ka").alias("text"))
    return words.unionByName(lists)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.look_alike_pairs(_looks(spark, folder))


def p2_forms(spark: SparkSession, folder: str) -> DataFrame:
    texts = _looks(spark, folder)
    return lookalike.forms(texts, lookalike.learn(texts), "text", "form", ["field", "key"])


def p2_classes(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.look_alike_classes(_looks(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbour_pairs(_table(spark, folder, "layout"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return copies.repeats(_table(spark, folder, "sentences"))


def p5_salted(spark: SparkSession, folder: str) -> DataFrame:
    """As p5_found, with so low a bound of heavy keys that there are some in small tables."""
    return copies.repeats(_table(spark, folder, "sentences"), least_rows=12)


def p5_copies(spark: SparkSession, folder: str) -> DataFrame:
    return copies.collapse(_table(spark, folder, "sentences"))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode_texts(_table(spark, folder, "documents"))


def p6_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every text from its ids again; null texts come out empty."""
    return encode.decode_ids(p6_ids(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return subjects.subject_areas(_table(spark, folder, "documents"), _table(spark, folder, "subjects"), _table(spark, folder, "subject_labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_sample": p1_sample, "p2_found": p2_found, "p2_forms": p2_forms, "p2_classes": p2_classes, "p4_found": p4_found, "p5_found": p5_found, "p5_salted": p5_salted, "p5_copies": p5_copies, "p6_ids": p6_ids, "p6_roundtrip": p6_roundtrip, "p7_found": p7_found, "p8_found": p8_found}


_WORDS_ONLY = "trim(regexp_replace(lower(upper({})), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g'))"

_SENTENCE_KEYS = f"""
WITH t AS (
  SELECT id, text, regexp_replace(text, '[\\s.!?…;,|•]+$', '') AS bare FROM sentences
  WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}]')
),
cut AS (
  SELECT t.id, s.n, list_filter(string_split(bare, s.sep), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) AS fields
  FROM t, (VALUES (1, ';'), (2, '|'), (3, '•'), (4, chr(10)), (5, ',')) s(n, sep)
  WHERE regexp_matches(t.text, '[:=–]')
),
records AS (
  SELECT id, min_by(fields, n) AS fields FROM cut
  WHERE len(fields) >= 2 AND len(list_filter(fields, lambda x: NOT regexp_matches(x, '^[^:=–]*[\\p{{L}}\\p{{N}}][^:=–]*[:=–](.|\\n)*[\\p{{L}}\\p{{N}}]'))) = 0
  GROUP BY id
),
forms AS (
  SELECT t.id, {_WORDS_ONLY.format("t.text")} AS w, CASE WHEN r.id IS NOT NULL THEN ';' || array_to_string(list_sort(list_transform(r.fields, lambda x:
      {_WORDS_ONLY.format("regexp_extract(x, '^[^:=–]*')")} || '=' || {_WORDS_ONLY.format("regexp_replace(x, '^[^:=–]*[:=–]', '')")})), ';') END AS f
  FROM t LEFT JOIN records r ON t.id = r.id
),
-- The same words or the same fields, over links of both kinds.
k1 AS (SELECT *, coalesce(min(f) OVER (PARTITION BY w), w) AS k FROM forms),
k2 AS (SELECT id, w, f, min(k) OVER (PARTITION BY coalesce(f, k)) AS k FROM k1),
k3 AS (SELECT id, w, f, min(k) OVER (PARTITION BY w) AS k FROM k2),
k4 AS (SELECT id, w, f, min(k) OVER (PARTITION BY coalesce(f, k)) AS k FROM k3),
keys AS (SELECT id, min(k) OVER (PARTITION BY w) AS form FROM k4)
"""


_REPEATS = _SENTENCE_KEYS + "SELECT * FROM (SELECT min(id) OVER (PARTITION BY form) AS first_id, id FROM keys) WHERE first_id < id"


def oracle_sql() -> dict[str, str]:
    return {
        "p6_roundtrip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
        "p1_sample": f"""
            SELECT sid, pos, lemma, form FROM (
              SELECT *, row_number() OVER (PARTITION BY sid, pos ORDER BY piece NULLS FIRST, arrived_at NULLS FIRST, lemma NULLS FIRST, form NULLS FIRST) AS r FROM occurrences
            ) WHERE r = 1
            ORDER BY md5('{SAMPLE_SEED}|' || coalesce(sid::varchar, '?') || '|' || coalesce(pos::varchar, '?')), sid, pos LIMIT {SAMPLE_SIZE}""",
        "p5_found": _REPEATS,
        "p5_salted": _REPEATS,
        "p5_copies": _SENTENCE_KEYS + "SELECT min(id) AS first_id, count(*) AS copies FROM keys GROUP BY form",
    }
