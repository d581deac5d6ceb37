"""Text that looks the same in one form (problem 2).

After compatibility normalisation and the deletion of characters that show nothing, each run of letters becomes a lattice: at
every place stand all letters that look like the one written there. Viterbi's algorithm takes the path of the highest score
under a bigram model of letters within each script, in which a change of script inside a run costs much. The score of a path
doesn't depend on which of the look-alikes was written, so runs that look the same have the same lattice and come out equal;
letter case, accents, punctuation and the number of spaces stay. The bigrams are counted over all texts that are compared, in runs
whose letters are all of one script and not all ambiguous.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import settle
from .words import CLASSES, drop_ignorable

CHANGE, BACKOFF = 12.0, 5.0  # cost of a change of script inside a run, in nats; weight of the letters' own chances
# The scripts that have look-alikes in one another, by the words that their letters' names begin with.
SCRIPTS = ("LATIN", "GEORGIAN", "CYRILLIC", "GREEK", "ARMENIAN", "COPTIC", "CHEROKEE", "LISU")
_class_of = {letter: c for c in CLASSES for letter in c}
_run = re.compile(r"(?:[^\W\d_][̀-ͯ]*)+")
_plain_marks = re.compile("[̀-ͯ]")
MEMO_LIMIT, ROWS_PER_BATCH, PAIRS_AT_ONCE = 300_000, 2000, 5_000
#: Rows of one look that one task takes; looks with more, or with 1 / MOST_HOT of all rows, are joined apart, so there are at most MOST_HOT.
ROWS_OF_A_LOOK, MOST_HOT = 100_000, 1_000_000


@lru_cache(65536)
def script(letter: str) -> str:
    word = unicodedata.name(letter, "?").split(" ", 1)[0]
    return word if word in SCRIPTS else "OTHER"


def fold(text: str) -> str:
    """Compatibility forms replaced, letters and accents apart, and without characters that show nothing."""
    return text if text.isascii() else unicodedata.normalize("NFD", drop_ignorable(unicodedata.normalize("NFKC", drop_ignorable(text))))


def bigrams(text: str) -> Iterator[tuple[str, str]]:
    """Pairs of neighbouring letters, with "" for the border, of the runs that can teach what a script looks like."""
    for run in _run.findall(fold(text)):
        letters = [c for c in run if not _plain_marks.match(c)]
        scripts = {script(c) for c in letters}
        if len(scripts) == 1 and "OTHER" not in scripts and any(c not in _class_of for c in letters):
            yield from zip(["", *letters], [*letters, ""])


class Model:
    """Chances of letters after each letter of their script, mixed with the letters' own chances; "" is the border of a run."""

    def __init__(self, counts: dict[tuple[str, str], int]) -> None:
        self.pair = counts
        self.after: Counter[str] = Counter()
        self.own: Counter[str] = Counter()
        for (a, b), n in counts.items():
            self.after[a] += n
            self.own[b] += n
        self.total = sum(self.own.values())

    def step(self, before: str, letter: str) -> float:
        own = (self.own[letter] + 0.01) / (self.total + 2)
        return math.log((self.pair.get((before, letter), 0) + BACKOFF * own) / (self.after[before] + BACKOFF))


def best_path(run: str, model: Model) -> str:
    """The likeliest letters of a run; of equal scores the class's first letters."""
    # Score, last letter, and the letters so far as a chain of pairs, which costs the same for runs of any length.
    paths: list[tuple[float, str, tuple]] = [(0.0, "", ())]
    for c in run:
        if _plain_marks.match(c):
            paths = [(s, last, (chain, c)) for s, last, chain in paths]
            continue
        onward = []
        for letter in _class_of.get(c, (c,)):
            best = None
            for s, last, chain in paths:
                same = not last or script(last) == script(letter)
                score = s + model.step(last if same else "", letter) - (0 if same else CHANGE)
                if best is None or score > best[0] + 1e-9:
                    best = (score, letter, (chain, letter))
            onward.append(best)
        paths = onward
    top = None
    for s, last, chain in paths:
        score = s + model.step(last, "")
        if top is None or score > top[0] + 1e-9:
            top = (score, chain)
    letters, chain = [], top[1]
    while chain:
        chain, letter = chain
        letters.append(letter)
    return "".join(reversed(letters))


class Forms(dict):
    """The one form of each run; a memo of bounded size."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def __missing__(self, run: str) -> str:
        if len(self) > MEMO_LIMIT:
            self.clear()
        found = best_path(run, self.model) if any(c in _class_of for c in run) else run
        if len(run) <= 64:
            self[run] = found
        return found


def one_look(text: str, forms: Forms) -> str:
    text = fold(text).replace("‐", "-")
    return unicodedata.normalize("NFC", _run.sub(lambda m: forms[m[0]], text))


def learn(texts: DataFrame, text_col: str = "text") -> Model:
    """The model, from all texts. Letters of five scripts form its pairs, so what is collected has a bound."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, str]] = Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    found.update(bigrams(text))
        a, b2 = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b2, pa.string()), pa.array(list(found.values()), pa.int64())], names=["a", "b", "n"])

    counts = texts.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return Model({(r["a"], r["b"]): r["n"] for r in counts.collect()})


def forms(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "form", keep: list[str] = ()) -> DataFrame:
    """``keep``, ``text_col`` and ``out_col``: each text in its one form; null for null, empty for empty. Whole texts of any length."""
    keep = list(keep)
    chosen = df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("__text"))
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(chosen.schema[c] for c in keep), T.StructField(text_col, T.StringType()), T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Forms(sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                text = b.column(len(keep))
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], text, pa.array([None if t is None else one_look(t, memo) for t in text.to_pylist()], pa.string())], names=schema.names)

    return chosen.mapInArrow(run, schema)


def _of_several(texts: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows whose look is written in several ways, with ``n`` (rows of that look) and ``first`` (its least key), and the columns of a look.

    Looks are counted before the shuffle, and rows of a hot look meet it by a
    broadcast of the few hot looks, so no task gets a hot look whole."""
    form = forms(texts.where("key is not null"), learn(texts), "text", "form", ["field", "key"]).where(F.col("form").rlike(r"[\p{L}\p{N}]"))
    rows = settle(form.select("field", "key", "text", F.xxhash64("form").alias("h1"), F.xxhash64("form", F.lit(2)).alias("h2")), "forms")
    look = ["field", "h1", "h2"]
    each = [F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.min("text").alias("low"), F.max("text").alias("high")]
    several = settle(rows.groupBy(*look).agg(*each).where("low <> high").drop("low", "high"), "looks")
    hot = several.where(F.col("n") > max(ROWS_OF_A_LOOK, rows.count() // MOST_HOT))
    if hot.isEmpty():
        return rows.join(several, look), look
    light = rows.join(F.broadcast(hot.select(*look)), look, "left_anti").join(several, look)
    return light.unionByName(rows.join(F.broadcast(hot), look)), look


def look_alike_classes(texts: DataFrame) -> DataFrame:
    """``field``, ``key``, ``first_key``, ``members``: each row whose look stands in several writings, with the least key and the
    number of rows of that look. All pairs of rows that look the same follow from it, without being put out one by one.

    Null keys, null texts and texts without a letter or digit have no look. Repeated rows count each."""
    rows, _ = _of_several(texts)
    return rows.select("field", "key", F.col("first").alias("first_key"), F.col("n").alias("members"))


def look_alike_pairs(texts: DataFrame) -> DataFrame:
    """``field``, ``key_a``, ``key_b`` of the rows of ``texts`` (field, key, text) that look the same in one field and differ in characters.

    key_a < key_b; each pair comes once for each pair of rows. Null keys, null texts and texts without a letter or digit have no
    pairs. The result has all such pairs, so a look that many rows share in many writings has many; such looks are spread by
    salt. ``look_alike_classes`` tells the same in a row for each row."""
    rows, look = _of_several(texts)
    of_look = rows.withColumn("salts", F.ceil(F.col("n") / PAIRS_AT_ONCE).cast("int"))
    left = of_look.select(*look, F.col("key").alias("key_a"), F.col("text").alias("text_a"), F.pmod(F.xxhash64("key"), F.col("salts")).cast("int").alias("salt"))
    right = of_look.select(*look, F.col("key").alias("key_b"), F.col("text").alias("text_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return left.join(right, [*look, "salt"]).where("key_a < key_b AND text_a <> text_b").select("field", "key_a", "key_b")
