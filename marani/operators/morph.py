"""Morphological expansion from affix files of the public Hunspell format (two-letter flags, circumfixes).

The rules are a small table, stems join it on their flags; a suffix's own flags join the prefixes that complete it. One suffix
and one prefix is as deep as such a file goes, so two joins do and nothing recurs."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.alphabet import GEORGIAN, Alphabet

RULES = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("flag", T.StringType(), False),
        T.StructField("cross_product", T.BooleanType(), False),
        T.StructField("strip", T.StringType(), False),
        T.StructField("add", T.StringType(), False),
        T.StructField("add_flags", T.ArrayType(T.StringType(), False), False),
        T.StructField("cond", T.StringType(), False),
    ]
)


def flags_of(text: str, kind: str = "long") -> list[str]:
    """The flags in a flag field: pairs of characters (``long``), numbers between commas (``num``), or single characters."""
    if kind == "long":
        return [text[n : n + 2] for n in range(0, len(text) - 1, 2)]
    return [x for x in text.split(",") if x] if kind == "num" else list(text)


@dataclass
class Affixes:
    rules: list[tuple]
    flag_kind: str = "short"
    forbidden: str | None = None
    need_affix: str | None = None
    circumfix: str | None = None


def parse_affixes(text: str) -> Affixes:
    """Read an affix file: its settings and the rules of all prefix and suffix classes. Lines of other kinds are passed over."""
    out = Affixes([])
    cross: dict[tuple[str, str], bool] = {}
    single = {"FLAG": "flag_kind", "FORBIDDENWORD": "forbidden", "NEEDAFFIX": "need_affix", "CIRCUMFIX": "circumfix"}
    for line in text.lstrip("﻿").splitlines():
        part = line.split()
        if len(part) >= 2 and part[0] in single:
            setattr(out, single[part[0]], part[1])
        elif len(part) >= 4 and part[0] in ("PFX", "SFX"):
            if (part[0], part[1]) not in cross:  # the head of a class
                cross[part[0], part[1]] = part[2] == "Y"
                continue
            add, _, own = part[3].partition("/")
            cond = part[4] if len(part) > 4 and not part[4].startswith("#") else "."
            out.rules.append((part[0], part[1], cross[part[0], part[1]], "" if part[2] == "0" else part[2], "" if add == "0" else add, flags_of(own, out.flag_kind), cond))
    return out


def rules_table(spark: SparkSession, affixes: Affixes) -> DataFrame:
    return spark.createDataFrame(affixes.rules, RULES)


def apply_suffix(word: str, strip: str, add: str, cond: str = ".") -> str | None:
    """A word with a suffix rule applied, None if the rule doesn't fit; for tests and single words."""
    if not word.endswith(strip) or (cond != "." and not re.search(f"(?:{cond})$", word)):
        return None
    return word[: len(word) - len(strip)] + add


def _fitting(rows: DataFrame, word: str, end: bool) -> DataFrame:
    w, strip, cond = F.col(word), F.col("strip"), F.col("cond")
    fits = F.endswith(w, strip) if end else F.startswith(w, strip)
    pattern = F.concat(F.lit("(?:"), cond, F.lit(")$")) if end else F.concat(F.lit("^(?:"), cond, F.lit(")"))
    return rows.where(fits & ((cond == ".") | F.regexp_like(w, pattern)) & (F.length(w) > F.length(strip)))


def expand(stems: DataFrame, affixes: Affixes) -> DataFrame:
    """``stem``, ``form``: all forms of each stem (``stem``, ``flags ARRAY<STRING>``), distinct.

    A stem stands for itself unless it needs an affix; forbidden stems and all forms that are also forbidden are left out. A half of a
    circumfix is a form only together with its other half."""
    spark = stems.sparkSession
    rules = F.broadcast(rules_table(spark, affixes))  # as long as the affix file
    s = stems.select("stem", F.coalesce("flags", F.array().cast("array<string>")).alias("flags")).where("stem IS NOT NULL AND stem <> ''")
    has = lambda col, flag: F.array_contains(col, flag) if flag else F.lit(False)
    forbidden = s.where(has("flags", affixes.forbidden)).select(F.col("stem").alias("form")).distinct()
    living = s.where(~has("flags", affixes.forbidden))
    bare = living.where(~has("flags", affixes.need_affix)).select("stem", F.col("stem").alias("form"))
    each = living.select("stem", F.col("flags").alias("stem_flags"), F.explode(F.array_distinct("flags")).alias("flag"))
    suffixed = _fitting(each.join(rules.where("kind = 'SFX'"), "flag"), "stem", True).select(
        "stem", "stem_flags", "cross_product", "add_flags", F.concat(F.expr("left(stem, length(stem) - length(strip))"), "add").alias("form")
    )
    half = has("add_flags", affixes.circumfix)
    needs = half | has("add_flags", affixes.need_affix)
    prefixes = rules.where("kind = 'PFX'").select(F.col("flag").alias("p_flag"), F.col("cross_product").alias("p_cross"), "strip", F.col("add").alias("p_add"), F.col("add_flags").alias("p_flags"), "cond")
    # A suffixed form takes the prefixes that its suffix names and, where both classes allow it, those of its stem.
    open_ = suffixed.withColumn("half", half).withColumn("p_flag", F.explode(F.array_distinct(F.concat("add_flags", F.when(F.col("cross_product"), F.col("stem_flags")).otherwise(F.array().cast("array<string>"))))))
    p_half = has("p_flags", affixes.circumfix)
    both = _fitting(open_.join(prefixes, "p_flag"), "form", False).where((F.col("half") == p_half) & (F.array_contains("add_flags", F.col("p_flag")) | F.col("p_cross")))
    both = both.select("stem", F.concat("p_add", F.expr("substring(form, length(strip) + 1)")).alias("form"))
    prefixed = _fitting(each.withColumnRenamed("flag", "p_flag").join(prefixes, "p_flag"), "stem", False).where(~p_half).select("stem", F.concat("p_add", F.expr("substring(stem, length(strip) + 1)")).alias("form"))
    forms = bare.unionByName(suffixed.where(~needs).select("stem", "form")).unionByName(both).unionByName(prefixed)
    return forms.join(forbidden, "form", "left_anti").select("stem", "form").distinct()


def form_lemma_pairs(expanded: DataFrame, lemmas: DataFrame | None = None, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``form``, ``lemma``, folded and of words of two letters or more; every stem and every lemma of the list maps to itself."""
    pairs = expanded.select(X.fold(F.col("form")).alias("form"), X.fold(F.col("stem")).alias("lemma"))
    pairs = pairs.unionByName(pairs.select(F.col("lemma").alias("form"), "lemma"))
    if lemmas is not None:
        own = X.fold(F.col(lemmas.columns[0]))
        pairs = pairs.unionByName(lemmas.select(own.alias("form"), own.alias("lemma")))
    good = lambda c: X.is_word(F.col(c), alphabet) & (F.length(c) >= 2)
    return pairs.where(good("form") & good("lemma")).distinct()
