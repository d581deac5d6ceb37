"""Readers: every text and table source, with explicit schemas."""

from __future__ import annotations

import io
import mimetypes
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.alphabet import GEORGIAN, Alphabet
from ..operators.emoji import plain_keywords

SENTENCES = "id long, article string, text string"
VOCAB = "i int, word string, lemma string, freq long, occ array<struct<sid:long,form:string>>"
VERSE = "id string, line string, chapter string, chapter_id string, strophe_id string, line_id string"
EMOJI = "emoji string, keywords_ka string"
PROBE = "array<struct<word:string,expected:array<string>,forbidden:array<string>>>"


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are passed over, broken ones dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary in JSON lines, of which each occurrence is a pair [sentence id, form]."""
    raw = spark.read.schema("i int, word string, lemma string, freq long, occ array<array<string>>").json(path)
    return raw.withColumn("occ", F.transform("occ", lambda x: F.struct(x[0].cast("long").alias("sid"), x[1].alias("form"))))


def verse(spark: SparkSession, path: str) -> DataFrame:
    """Verse lines from a CSV file with a header, all columns as text but the id, which orders them."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(VERSE).csv(path)
    return rows.withColumn("id", F.col("id").cast("long"))


def filled_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header, in which missing text is empty text."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path).na.fill("")


def pages(entries: DataFrame) -> DataFrame:
    """Archive entries (``path``, ``title``, ``mimetype``, ``redirect``, ``content BINARY``) that are pages, as ``page_id``, ``title``, ``html``.

    Redirects and other types are dropped before anything is decoded; bytes that aren't UTF-8 are dropped from the text."""
    good = entries.where(~F.coalesce("redirect", F.lit(False)) & F.contains("mimetype", F.lit("html")) & F.col("content").isNotNull())

    @F.pandas_udf("string")  # made when called, within a session
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield p.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    return good.select(F.col("path").alias("page_id"), "title", decode("content").alias("html"))


def archive(spark: SparkSession, path: str) -> DataFrame:
    """The entries of ZIP archives as ``pages`` takes them; the type follows from the name. An archive is read by one task, an entry at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                    for e in z.infolist():
                        if e.is_dir():
                            continue
                        kind = mimetypes.guess_type(e.filename)[0] or "application/octet-stream"
                        try:
                            data = z.read(e)
                        except (zipfile.BadZipFile, NotImplementedError, RuntimeError):
                            continue  # an entry that can't be read is passed over
                        yield pd.DataFrame({"path": [e.filename], "title": [e.filename.rsplit("/", 1)[-1].rsplit(".", 1)[0]], "mimetype": [kind], "redirect": [False], "content": [data]})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "path string, title string, mimetype string, redirect boolean, content binary")


def xml_dump(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``ts``, ``title``, ``author``, ``text``, ``sha1``, ``is_redirect`` of the pages of namespace 0 of an XML dump."""
    schema = "id string, ns string, title string, revision struct<timestamp:string,contributor:struct<username:string,ip:string>,text:struct<_VALUE:string>,sha1:string>"
    p = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path).where("ns = '0'")
    text = F.col("revision.text._VALUE")
    return p.select("id", F.col("revision.timestamp").alias("ts"), "title", F.coalesce("revision.contributor.username", "revision.contributor.ip").alias("author"), text.alias("text"), F.col("revision.sha1").alias("sha1"), X.is_redirect(text).alias("is_redirect"))


def config(path: str, folder: str | None = None) -> dict:
    """A YAML file, by its path or by its id in a folder; where it was read from stands under ``_config_path``."""
    at = path if path.endswith((".yaml", ".yml")) or folder is None else f"{folder}/{path}.yaml"
    with open(at, encoding="utf-8") as f:
        return (yaml.safe_load(f) or {}) | {"_config_path": at}


def word_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``word``: all words of lists with one word on each line, folded; without comments and blank lines."""
    word = X.fold(F.btrim(F.regexp_replace("value", "#.*$", "")))
    return spark.read.text(list(paths)).select(word.alias("word")).where("word <> ''").distinct()


def lemma_list(spark: SparkSession, path: str, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``lemma``: the first column of a CSV file that holds words of two letters or more, without a header called word."""
    first = X.fold(F.btrim(F.col("_c0")))
    return spark.read.schema("_c0 string").csv(path).select(first.alias("lemma")).where((F.col("lemma") != "word") & X.is_word(F.col("lemma"), alphabet) & (F.length("lemma") >= 2)).distinct()


def dictionary(spark: SparkSession, path: str, flag_kind: str = "long") -> DataFrame:
    """``stem``, ``flags`` of a Hunspell dictionary; the line that holds the count is passed over."""
    parts = F.split(F.regexp_replace(F.btrim("value"), r"\s.*$", ""), "/")
    field = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    cut = {"long": F.regexp_extract_all(field, F.lit(".."), 0), "num": F.filter(F.split(field, ","), lambda x: x != "")}.get(flag_kind, F.filter(F.split(field, ""), lambda x: x != ""))
    return spark.read.text(path).where(r"btrim(value) <> '' AND NOT btrim(value) RLIKE '^[0-9]+$'").select(parts[0].alias("stem"), cut.alias("flags"))


def matrix(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """``i``, ``vec`` of a NumPy file (of a named array of an archive, where ``name`` is given), read by one task for each file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                data = bytes(content)
                if name is not None:
                    with zipfile.ZipFile(io.BytesIO(data)) as z:
                        data = z.read(f"{name}.npy")
                m = np.load(io.BytesIO(data), allow_pickle=False)
                for at in range(0, len(m), 4096):
                    part = m[at : at + 4096].astype("f4").reshape(-1, 1 if m.ndim == 1 else m.shape[1])
                    yield pd.DataFrame({"i": np.arange(at, at + len(part), dtype="i4"), "vec": list(part)})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "i int, vec array<float>")


def labels(spark: SparkSession, path: str) -> DataFrame:
    """``i``, ``word``, ``freq`` of a label file: word and frequency with a tab between them, in the order of the index; no frequency is 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for whole in b["value"]:
                lines = [x for x in whole.split("\n") if x]
                cut = [x.partition("\t") for x in lines]
                yield pd.DataFrame({"i": range(len(cut)), "word": [a for a, _, _ in cut], "freq": [int(c) if c.strip() else 0 for _, _, c in cut]})

    return spark.read.text(path, wholetext=True).mapInPandas(run, "i int, word string, freq long")


def emoji_keywords(spark: SparkSession, path: str) -> DataFrame:
    """``emoji``, ``rank``, ``keyword``."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.select("emoji", F.posexplode(plain_keywords(F.col("keywords_ka"))).alias("rank", "keyword"))


def probes(spark: SparkSession, path: str, corpus: str) -> DataFrame:
    """``word``, ``expected``, ``forbidden`` of one corpus in a probe file."""
    rows = spark.read.option("multiLine", True).schema(f"`{corpus}` {PROBE}").json(path)
    return rows.select(F.explode(corpus).alias("p")).select("p.word", F.coalesce("p.expected", F.array().cast("array<string>")).alias("expected"), F.coalesce("p.forbidden", F.array().cast("array<string>")).alias("forbidden"))


def probe_thresholds(spark: SparkSession, path: str) -> dict[str, float]:
    """The least hit rate of each corpus in a probe file."""
    rows = spark.read.option("multiLine", True).schema("thresholds map<string,struct<hit_rate:double>>").json(path)
    return {r["key"]: r["value"]["hit_rate"] for r in rows.select(F.explode("thresholds")).collect() if r["value"] and r["value"]["hit_rate"] is not None}


def analogies(spark: SparkSession, path: str) -> DataFrame:
    """``a``, ``b``, ``c``, ``d`` of a JSON list of four words each."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("q"))
    w = F.split(X.one_space(F.col("q")), " ")
    return rows.where(F.size(w) == 4).select(*(w[n].alias(c) for n, c in enumerate("abcd")))


def related_terms(spark: SparkSession, path: str) -> DataFrame:
    """``subject``, ``term`` of a JSON map from subjects to lists."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("subject", "terms"))
    return rows.select("subject", F.explode("terms").alias("term"))


def whole_text(spark: SparkSession, path: str, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``path``, ``sentences``: each file as a whole, cut into sentences."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.input_file_name().alias("path"), X.split_sentences(F.col("value"), alphabet).alias("sentences"))
