"""Corpus operators: sentences from documents, first-wins deduplication, dense ids, runs of equal keys, older token corpora."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.alphabet import GEORGIAN, Alphabet
from ..runtime import settle, spread


def sentences(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``id_col``, ``sent_ix`` (from 0), ``sentence``: one row for each sentence of each document."""
    rows = spread(documents.select(id_col, text_col))
    return rows.select(F.col(id_col), F.posexplode(X.split_sentences(F.col(text_col), alphabet)).alias("sent_ix", "sentence"))


def kept_sentences(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", alphabet: Alphabet = GEORGIAN, **limits: float) -> DataFrame:
    return sentences(documents, id_col, text_col, alphabet).where(X.keep_sentence(F.col("sentence"), alphabet, **limits))


def first_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each value of ``key`` by ``order``. Aggregated before the shuffle, so a key that half of all rows have is no burden.

    Null keys are one group. Ties in ``order`` are settled by the other columns."""
    rest = [c for c in df.columns if c not in (key, *order)]
    first = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("__first"))
    return first.select(*(F.col(key) if c == key else F.col(f"__first.{c}").alias(c) for c in df.columns))


def _starts(ordered: DataFrame, sizes: list[tuple[int, int]]) -> DataFrame:
    """``__part``, ``__begin``: the number of rows before each partition; a row for each, so it is small."""
    starts, total = [], 0
    for part, size in sorted(sizes):
        starts.append((part, total))
        total += size
    return F.broadcast(ordered.sparkSession.createDataFrame(starts, "__part long, __begin long"))


def dense_ids(df: DataFrame, order: list[str], id_col: str = "id", label: str = "ordered") -> DataFrame:
    """Number all rows from 0 in a total order, without bringing them into one task: rows are sorted by range and numbered within
    their partition as they are written, and each partition starts at the number of rows before it. One number for each
    partition comes to the driver, and nothing is shuffled again."""
    ordered = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), label)
    placed = ordered.withColumn("__part", F.shiftright("__at", 33))
    sizes = [(r["__part"], r["count"]) for r in placed.groupBy("__part").count().collect()]
    place = F.col("__begin") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return placed.join(_starts(ordered, sizes), "__part").withColumn(id_col, place).drop("__part", "__begin", "__at")


def runs_in_order(df: DataFrame, order: str, keys: list[str], group_col: str = "group_ix", label: str = "runs") -> DataFrame:
    """Number the runs of consecutive rows with equal keys over all rows in one order; a key that comes again later starts a new run.

    Rows are sorted by range, and each partition numbers its own runs as it is written. A partition's first run goes on with the last
    one before it if their keys are equal; for that its number of runs and its first and last key come to the driver. Null keys
    are equal to each other and to nothing else."""
    key = F.to_json(F.struct(*(F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(keys))))
    ordered = df.withColumn("__key", key).repartitionByRange(F.col(f"`{order}`")).sortWithinPartitions(f"`{order}`", "__key")
    schema = T.StructType([*ordered.schema.fields, T.StructField("__part", T.LongType()), T.StructField("__run", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, last = TaskContext.get().partitionId(), 0, None
        for b in batches:
            if not b.num_rows:
                continue
            own = b.column(b.num_columns - 1)
            new = np.r_[last is not None and own[0].as_py() != last, np.asarray(pc.not_equal(own.slice(1), own.slice(0, len(own) - 1)), bool)]
            runs = run + np.cumsum(new)
            run, last = int(runs[-1]), own[len(own) - 1].as_py()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(own), part, np.int64)), pa.array(runs.astype(np.int64))], names=schema.names)

    settled = settle(ordered.mapInArrow(number, schema), label)
    ends = settled.groupBy("__part").agg(F.max("__run").alias("runs"), F.min_by("__key", "__run").alias("first"), F.max_by("__key", "__run").alias("last")).orderBy("__part").collect()
    starts, following, before = [], 0, None
    for r in ends:
        begin = following - 1 if before is not None and r["first"] == before else following
        starts.append((r["__part"], begin))
        following, before = begin + r["runs"] + 1, r["last"]
    begins = F.broadcast(df.sparkSession.createDataFrame(starts, "__part long, __begin long"))  # a row for each partition
    return settled.join(begins, "__part").withColumn(group_col, F.col("__begin") + F.col("__run")).drop("__part", "__begin", "__run", "__key")


def key_change_groups(df: DataFrame, partition: list[str], order: list[str], keys: list[str], group_col: str = "group_ix") -> DataFrame:
    """Number the runs of consecutive rows with equal keys: a key that comes again later starts a new run."""
    w = Window.partitionBy(*partition).orderBy(*order)
    changed = F.lit(False)
    for k in keys:
        changed = changed | ~F.col(k).eqNullSafe(F.lag(k).over(w))
    first = F.row_number().over(w) == 1
    return df.withColumn("__new", (first | changed).cast("int")).withColumn(group_col, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("__new")


def verse_sentences(lines: DataFrame, order: str = "id", keys: tuple[str, ...] = ("chapter_id", "strophe_id"), alphabet: Alphabet = GEORGIAN, min_ratio: float = 0.6) -> DataFrame:
    """The first key, ``group_ix``, ``first_line``, ``article``, ``text``: the lines of each run of equal chapter and strophe as one text, under its first chapter.

    Runs are those of all lines in one order, so a strophe that comes again after another one is a group of its own. A run whose
    lines are all empty has no row. No task sees more than its range of lines and the runs that it puts together."""
    runs = runs_in_order(lines, order, list(keys)).withColumn("__line", X.verse_line(F.col("line")))
    grouped = (
        runs.where(F.length("__line") > 0)
        .groupBy("group_ix")
        .agg(F.first(keys[0]).alias(keys[0]), F.min(F.struct(order, "chapter"))["chapter"].alias("article"), F.min(order).alias("first_line"), F.array_sort(F.collect_list(F.struct(order, "__line"))).alias("l"))
    )
    text = X.one_space(F.array_join(F.transform("l", lambda x: x["__line"]), " "))
    return grouped.select(keys[0], "group_ix", "first_line", "article", text.alias("text")).where(X.letter_ratio(F.col("text"), alphabet) >= min_ratio)


# Parts of a page that aren't running text.
JUNK_TAGS = frozenset("table sup style script math figure figcaption".split())
JUNK_CLASSES = frozenset("reference references reflist infobox navbox navbox-inner mw-editsection thumb gallery noprint metadata hatnote mw-empty-elt".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Paragraphs(HTMLParser):
    """Collects the text of paragraphs that aren't inside junk. A paragraph ends at its end tag, at the next one, or with what holds it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []  # tag, junk
        self.paragraph: list[str] | None = None
        self.found: list[str] = []
        self.body = False

    def _close(self) -> None:
        if self.paragraph is not None and (text := " ".join(self.paragraph)):
            self.found.append(text)
        self.paragraph = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.body |= tag == "body"
        if tag in VOID_TAGS:
            return
        classes = set((dict(attrs).get("class") or "").split())
        junk = tag in JUNK_TAGS or bool(classes & JUNK_CLASSES)
        if tag == "p":
            self._close()
            self.open = [x for n, x in enumerate(self.open) if x[0] != "p"]
            if not junk and not any(j for _, j in self.open):
                self.paragraph = []
        self.open.append((tag, junk))

    def handle_endtag(self, tag: str) -> None:
        if tag not in (t for t, _ in self.open):
            return
        while self.open:
            last, _ = self.open.pop()
            if last == "p":
                self._close()
            if last == tag:
                break

    def handle_data(self, data: str) -> None:
        if self.paragraph is not None and not any(j for _, j in self.open) and (t := data.strip()):
            self.paragraph.append(t)


def paragraphs_of(html: str | None) -> list[str]:
    """The texts of a page's paragraphs; none for a page without a body. Broken pages give what can be read."""
    parser = _Paragraphs()
    parser.feed(html or "")
    parser.close()
    parser._close()
    return parser.found if parser.body else []


@F.pandas_udf(T.ArrayType(T.StringType()))
def html_paragraphs(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(paragraphs_of)


def page_paragraphs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col``, ``para_ix``, ``text``. Filter redirects and other types of page before: filters don't pass a Python function."""
    return pages.where(F.col(html_col).isNotNull()).select(id_col, F.posexplode(html_paragraphs(html_col)).alias("para_ix", "text"))


def frequent_tokens(docs: DataFrame, id_col: str, tokens_col: str, least: int = 2, least_tokens: int = 2) -> DataFrame:
    """``id_col``, ``tokens_col``: the tokens that the whole corpus has at least ``least`` times, in their order, of the
    documents that keep at least ``least_tokens``. The counts are joined, not sent to each task, since they grow with the corpus."""
    each = docs.select(id_col, F.posexplode(tokens_col).alias("pos", "token"))
    often = each.groupBy("token").count().where(F.col("count") >= least).select("token")
    kept = each.join(often, "token").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("l"))
    return kept.where(F.size("l") >= least_tokens).select(id_col, F.transform("l", lambda x: x["token"]).alias(tokens_col))


def unit_corpus(lines: DataFrame, key: str, title: str | None = None, line: str = "line", order: str = "id") -> DataFrame:
    """``key``, ``text``: the words of two letters or more of each chapter, strophe or line, its title first; units with fewer than two are dropped.

    Lines are cleaned where they are read; what a unit brings together are its words, which are its row of the result."""
    words = lambda text: F.filter(F.split(X.cleanup(text), " "), lambda w: F.length(w) > 1)
    each = lines.select(key, order, F.array_join(words(F.coalesce(line, F.lit(""))), " ").alias("__words"), *([F.col(title).alias("__title")] if title else []))
    first = [F.min(F.struct(order, "__title"))["__title"].alias("__title")] if title else []
    grouped = each.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("__words") != "", F.struct(order, "__words")))).alias("l"), *first)
    parts = F.transform("l", lambda x: x["__words"])
    if title:
        parts = F.concat(F.array(F.array_join(words(F.coalesce("__title", F.lit(""))), " ")), parts)
    return grouped.select(key, F.array_join(F.filter(parts, lambda x: x != ""), " ").alias("text")).where(F.contains("text", F.lit(" ")))


def distinct_characters(df: DataFrame, col: str | Column) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.select(F.explode(F.split(c, "")).alias("character")).where("character <> ''").distinct()


def random_rows(df: DataFrame, number: int, id_col: str, seed: int = 1) -> DataFrame:
    """``number`` rows, each equally likely: those with the smallest random keys, of which each task keeps no more."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string"))), id_col).limit(number)


def other_namespaces(df: DataFrame, title_col: str = "title", known: tuple[str, ...] = X.NAMESPACES_DOCUMENT[:4]) -> DataFrame:
    """Titles with a colon that are in none of the known namespaces."""
    in_known = F.lit(False)
    for n in known:
        in_known = in_known | F.startswith(title_col, F.lit(n))
    return df.where(F.contains(title_col, F.lit(":")) & ~in_known)


def piece_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: the length of the longest piece between full stops, and the number of distinct words between spaces."""
    longest = df.select(F.array_max(F.transform(F.split(text_col, r"\."), lambda p: F.length(p))).alias("n")).agg(F.max("n").alias("longest_piece"))
    words = df.select(F.explode(F.split(text_col, " ")).alias("w")).agg(F.count_distinct("w").alias("distinct_words"))
    return longest.crossJoin(words)
