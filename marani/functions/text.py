"""Text functions as Catalyst expressions: splitting, filtering, folding, stemming, cleaning."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .alphabet import GEORGIAN, SPACE, Alphabet

_KEPT_DOT = "\u0001"  # a dot that doesn't end a sentence


def one_space(text: Column) -> Column:
    """Runs of white space, of any script, become one space; none at the ends."""
    return F.btrim(F.regexp_replace(text, f"{SPACE}+", " "))


def strip(text: Column) -> Column:
    """A text without white space, of any script, at its ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null and blank texts."""
    t = one_space(text)
    return F.when(t.isNull() | (t == ""), 0).otherwise(F.size(F.split(t, " ")))


def letter_ratio(text: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    """The part of all characters that are letters of the alphabet; 0 for empty and null texts."""
    own = F.length(F.regexp_replace(text, f"[^{alphabet.letters}]", ""))
    return F.when(F.length(text) > 0, own / F.length(text)).otherwise(F.lit(0.0))


def split_sentences(text: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    """Sentences of a text: cut after ``. ! ? …`` before white space, but not after abbreviations and single-letter initials.

    Null and blank texts give an empty list."""
    t = one_space(text)
    for a in sorted(alphabet.abbreviations, key=len, reverse=True):
        t = F.replace(t, F.lit(a), F.lit(a.replace(".", _KEPT_DOT)))
    t = F.regexp_replace(t, rf"(?<![{alphabet.letters}])([{alphabet.letters}])\.", f"$1{_KEPT_DOT}")
    parts = F.transform(F.split(t, "(?<=[.!?…]) "), lambda p: F.btrim(F.translate(p, _KEPT_DOT, ".")))
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def keep_sentence(text: Column, alphabet: Alphabet = GEORGIAN, min_words: int = 4, max_words: int | None = 60, min_ratio: float = 0.6) -> Column:
    """Whether a sentence has the wanted number of words and enough letters of the alphabet."""
    n = word_count(text)
    long_enough = n >= min_words if max_words is None else n.between(min_words, max_words)
    return long_enough & (letter_ratio(text, alphabet) >= min_ratio)


def fold(text: Column) -> Column:
    """Capital forms to small ones, Georgian capitals (Mtavruli) included."""
    return F.lower(text)


def tokens(text: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    """All runs of the alphabet's letters, as written."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"[{alphabet.letters}]+"), 0), F.array().cast("array<string>"))


def is_word(text: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    return F.coalesce(text.rlike(f"^[{alphabet.letters}]+$"), F.lit(False))


def word_pattern(form: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    """A pattern that finds a form only as a whole word."""
    return F.concat(F.lit(rf"(?<![{alphabet.letters}])\Q"), form, F.lit(rf"\E(?![{alphabet.letters}])"))


def holds_word(text: Column, form: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    return F.regexp_like(text, word_pattern(form, alphabet))


def stem(word: Column, alphabet: Alphabet = GEORGIAN) -> Column:
    """Take endings off, one at a time, until none is left or the stem would fall below the alphabet's least length.

    The longest ending that matches goes first; a word of n letters has at most n - min_stem endings, so so many steps are enough."""
    if not alphabet.suffixes:
        return word
    ending = "|".join(sorted(alphabet.suffixes, key=len, reverse=True))
    one = rf"^(.{{{alphabet.min_stem},}}?)(?:{ending})$"
    steps = F.sequence(F.lit(1), F.greatest(F.length(word) - alphabet.min_stem, F.lit(1)))
    return F.aggregate(steps, word, lambda w, _: F.regexp_replace(w, one, "$1"))


@pandas_udf(StringType())
def nfc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode normal form C; Spark has no function for it."""
    for t in texts:
        yield t.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def verse_line(line: Column) -> Column:
    """A line of verse without white space and then quotes at its ends."""
    return F.btrim(strip(line), F.lit('"'))


# Letters that the older corpora keep, and the titles that aren't articles.
OLD_LETTERS = "Ⴀ-ჿⴀ-ⴥᲐ-Ჿ"
NAMESPACES_LANGUAGE = ("ვიკიპედია:", "თარგი:", "კატეგორია:")
NAMESPACES_DOCUMENT = ("ვიკიპედია:", "თარგი:", "კატეგორია:", "დახმარება:", "პორტალი:")
REDIRECTS = ("#გადამისამართება", "#REDIRECT")


def cleanup(text: Column, keep: str = "article") -> Column:
    """Small letters with all else replaced by spaces: ``sentence`` keeps full stops, ``document`` digits, ``article`` neither."""
    more = {"sentence": ".", "document": "0-9", "article": ""}[keep]
    return one_space(F.regexp_replace(F.lower(text), f"[^{OLD_LETTERS}{more}]", " "))


def real_page(title: Column, text: Column, namespaces: tuple[str, ...] = NAMESPACES_LANGUAGE, alphabet: Alphabet = GEORGIAN) -> Column:
    """Whether a page is an article: not blank, with letters, not a redirect and not in one of the namespaces. A null title is none of these."""
    body = F.coalesce(text, F.lit(""))
    name = F.coalesce(title, F.lit(""))
    other = reduce(lambda a, b: a | b, [name.startswith(n) for n in namespaces], F.lit(False))
    redirect = reduce(lambda a, b: a | b, [body.startswith(r) for r in REDIRECTS])
    return (one_space(body) != "") & body.rlike(f"[{alphabet.letters}]") & ~other & ~redirect


def weave_title(title: Column, text: Column, kind: str = "sentence") -> Column:
    """The title before the text as a sentence of its own, or (``article``, ``document``) before and after it."""
    t, b = F.coalesce(title, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(t, F.lit(". "), b) if kind == "sentence" else F.concat_ws(" ", t, b, t)


def token_sentences(text: Column) -> Column:
    """Sentences between full stops as lists of the words of two letters or more; without empty ones."""
    each = F.transform(F.split(text, r"\."), lambda s: F.filter(F.split(s, " "), lambda w: F.length(w) > 1))
    return F.filter(each, lambda s: F.size(s) > 0)


def input_window(template: str, sentence: Column, form: Column, alphabet: Alphabet = GEORGIAN, reach: int = 240) -> Column:
    """STRUCT<text, start, end>: a crop of the sentence around a form, put into the template, and where the form stands in it.

    The form is looked for as a whole word, else anywhere; null if it isn't there. The crop begins after the last space before
    ``reach`` characters ahead of the form and ends at the first space ``reach`` characters behind it, or at the text's ends."""
    first = F.position(form, sentence)
    # The characters around the first place say mostly whether it is a whole word; only where it isn't a pattern is made to look further.
    around = F.concat(F.substring(sentence, first - 1, F.when(first > 1, 1).otherwise(0)), F.substring(sentence, first + F.length(form), F.lit(1)))
    further = F.regexp_instr(sentence, word_pattern(form, alphabet))
    start = F.when((first == 0) | ~around.rlike(f"[{alphabet.letters}]"), first).when(further > 0, further).otherwise(first) - 1
    end = start + F.length(form)
    ahead = F.substring(sentence, F.lit(1), F.greatest(start - reach, F.lit(0)))
    space_before = F.length(ahead) - F.position(F.lit(" "), F.reverse(ahead)) + 1  # behind the last space, if there is one
    left = F.when(F.contains(ahead, F.lit(" ")), space_before).otherwise(F.lit(0))
    behind = F.position(F.lit(" "), sentence, end + reach + 1)
    right = F.when((end + reach >= F.length(sentence)) | (behind == 0), F.length(sentence)).otherwise(behind - 1)
    crop = F.substring(sentence, left + 1, right - left)
    offset = template.index("{text}")
    text = F.concat(F.lit(template[:offset]), crop, F.lit(template[offset + 6 :]))
    found = F.struct(text.alias("text"), (start - left + offset).alias("start"), (end - left + offset).alias("end"))
    return F.when((F.length(form) > 0) & (start >= 0), found)


def _for_each(text: Column, opening: str, step: Callable[[Column], Column]) -> Column:
    """The step as often as the text still has openings, so to any depth; the text is bound, to be worked out once."""
    again = lambda t: F.aggregate(F.array_repeat(F.lit(0), F.regexp_count(t, F.lit(opening))), t, lambda s, _: step(s))
    return F.element_at(F.transform(F.array(text), again), 1)


def remove_markup(text: Column) -> Column:
    """Wiki text without its markup: comments, references, tables, templates, files and categories go, links leave their words.

    Templates, tables and links may stand in one another to any depth."""

    def template(t: Column) -> Column:
        return F.regexp_replace(t, r"(?s)\{\{[^{}]*\}\}", "")

    def table(t: Column) -> Column:
        return F.regexp_replace(t, r"(?s)\{\|((?!\{\||\|\}).)*\|\}", "")

    def link(t: Column) -> Column:
        t = F.regexp_replace(t, r"\[\[(?:[^\[\]:|]+):[^\[\]]*\]\]", "")
        return F.regexp_replace(t, r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", "$1")

    t = F.regexp_replace(text, r"(?s)<!--.*?-->|<ref[^>/]*/>|<ref[^>]*>.*?</ref>|<(math|nowiki|gallery)[^>]*>.*?</\1>", "")
    # The usual depths at once, so that few texts have openings left for which the steps are repeated.
    for step in (template, table):
        for _ in range(4):
            t = step(t)
    t = _for_each(t, r"\{[{|]", lambda x: table(template(x)))
    t = _for_each(link(link(t)), r"\[\[", link)
    t = F.regexp_replace(t, r"\[(?:https?|ftp)://[^\s\]]+\s*([^\]]*)\]", "$1")
    t = F.regexp_replace(t, r"</?[a-zA-Z][^<>]*>|'{2,}", "")
    return F.regexp_replace(t, r"(?m)^=+\s*(.*?)\s*=+\s*$", "$1")


def is_redirect(text: Column) -> Column:
    return F.coalesce(text.startswith(REDIRECTS[0]) | text.startswith(REDIRECTS[1]), F.lit(False))
