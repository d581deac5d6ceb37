from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marani.functions import text as X
from marani.functions.alphabet import GEORGIAN, LATIN, Alphabet


def one(spark, *values):
    """A frame of one row with the values as columns v0, v1 and so on."""
    return spark.createDataFrame([values], ", ".join(f"v{n} string" for n in range(len(values))))


def result(spark, f, *values):
    return one(spark, *values).select(f(*(F.col(f"v{n}") for n in range(len(values)))).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "count"),
    [
        ("ერთი წინადადება. მეორე წინადადება.", 2),
        ("მან თქვა ე.წ. სიმართლე და წავიდა.", 1),
        ("ავტორია ი. ჭავჭავაძე დიდი მწერალი.", 1),
        ("ავტორები ა. ბ. გ. დიდი მწერლები. კიდევ ერთი.", 2),
        ("რა? სად! როდის… აქ.", 4),
        ("ერთი. ორი. სამი.　ოთხი.", 4),
        ("", 0),
        ("   \n\t", 0),
        (None, 0),
    ],
)
def test_split(spark, text, count):
    assert len(result(spark, X.split_sentences, text)) == count


def test_split_keeps_letters(spark):
    assert result(spark, X.split_sentences, "ჱ ჲ ჳ ჴ ჵ ჶ არს ძველი ანბანი დიდი.") == ["ჱ ჲ ჳ ჴ ჵ ჶ არს ძველი ანბანი დიდი."]


@pytest.mark.parametrize(("text", "ratio"), [("აბგ123", 0.5), ("", 0.0), ("ჶ", 1.0), (None, 0.0), ("ა ბ", 2 / 3)])
def test_ratio(spark, text, ratio):
    assert result(spark, X.letter_ratio, text) == pytest.approx(ratio)


def test_keep(spark):
    assert result(spark, X.keep_sentence, "ერთი ორი სამი ოთხი.")
    assert not result(spark, X.keep_sentence, "ერთი ორი სამი.")
    assert not result(spark, X.keep_sentence, "one two three four five")
    assert result(spark, lambda c: X.keep_sentence(c, LATIN), "one two three four five")
    assert not result(spark, lambda c: X.keep_sentence(c, max_words=4), "ერთი ორი სამი ოთხი ხუთი")


def test_words(spark):
    assert result(spark, X.holds_word, "მზე ანათებს", "მზე")
    assert not result(spark, X.holds_word, "ამზერა", "მზე")
    assert result(spark, X.fold, "ᲐᲑᲒ") == "აბგ"
    assert result(spark, X.tokens, "მზე, და 5 word მთვარე") == ["მზე", "და", "მთვარე"]
    assert [result(spark, X.is_word, w) for w in ("სიტყვა", "word", "სიტყვა1", "", None)] == [True, False, False, False, False]
    assert result(spark, X.nfc, "é") == "é"


def plain_stem(word, alphabet=GEORGIAN):
    """Take endings off one at a time, the longest first, as long as the stem stays long enough."""
    while True:
        for s in sorted(alphabet.suffixes, key=len, reverse=True):
            if word.endswith(s) and len(word) - len(s) >= alphabet.min_stem:
                word = word[: -len(s)]
                break
        else:
            return word


def test_stem(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("აბდეიმოსთრზენხვ") for _ in range(rng.randint(1, 6))) + "".join(rng.choice(GEORGIAN.suffixes) for _ in range(rng.randint(0, 3))) for _ in range(800)]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", X.stem(F.col("w")).alias("s")).collect()
    assert all(r["s"] == plain_stem(r["w"]) for r in rows)
    roots = {result(spark, X.stem, w) for w in "დედა დედამ დედას დედები დედებში".split()}
    assert len(roots) == 1 and result(spark, X.stem, "დედალი") not in roots
    assert result(spark, X.stem, "ცა") == "ცა"
    assert result(spark, lambda c: X.stem(c, Alphabet("none", "a-z")), "walking") == "walking"


def plain_window(template, sentence, form, reach):
    import re

    m = re.search(rf"(?<![ა-ჿ]){re.escape(form)}(?![ა-ჿ])", sentence)
    at = m.start() if m else sentence.find(form)
    if at < 0 or not form:
        return None
    end = at + len(form)
    cut = sentence[: max(0, at - reach)].rfind(" ")
    low = cut + 1 if cut >= 0 else 0
    after = sentence.find(" ", end + reach)
    high = after if after >= 0 else len(sentence)
    head = template.index("{text}")
    return template.replace("{text}", sentence[low:high]), head + at - low, head + end - low


def test_window(spark):
    rng = random.Random(5)
    cases = []
    for _ in range(300):
        words = ["".join(rng.choice("აბგდ") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))]
        cases.append((" ".join(words), rng.choice([*words, "აბ", "ჟჟ", "ა"])))
    rows = spark.createDataFrame(cases, "s string, f string").select("s", "f", X.input_window("t: {text}!", F.col("s"), F.col("f"), reach=6).alias("w")).collect()
    for r in rows:
        assert (tuple(r["w"]) if r["w"] else None) == plain_window("t: {text}!", r["s"], r["f"], 6), (r["s"], r["f"])


def test_older_forms(spark):
    assert result(spark, lambda c: X.cleanup(c, "sentence"), "ᲐᲑ ბ. 5, x") == "აბ ბ."
    assert result(spark, lambda c: X.cleanup(c, "document"), "ᲐᲑ ბ. 5, x") == "აბ ბ 5"
    assert result(spark, X.cleanup, "ᲐᲑ ბ. 5, x") == "აბ ბ"
    assert result(spark, X.token_sentences, "აბ ბ. . გდ ევ") == [["აბ"], ["გდ", "ევ"]]
    assert result(spark, X.weave_title, "ა", "ბ") == "ა. ბ"
    assert result(spark, lambda t, b: X.weave_title(t, b, "article"), "ა", "ბ") == "ა ბ ა"
    real = lambda t, b: X.real_page(t, b)
    assert result(spark, real, "ა", "ბ") and result(spark, real, None, "ბ")
    assert not any(result(spark, real, *x) for x in (("თარგი:ა", "ბ"), ("ა", "#REDIRECT ბ"), ("ა", "abc"), ("ა", " "), ("ა", None)))
    assert result(spark, X.verse_line, ' "ა ბ"  ') == "ა ბ"


def test_markup(spark):
    text = "== თავი ==\n'''მზე''' {{ინფო|{{x}}|a}}[[ცა|ცის]] და [[მთა]] [[კატეგორია:ა]]<ref name=\"a\">no</ref><ref name=b/> [http://x.y ბმული]{| table\n| {| in |}\n|}<!-- c -->."
    assert result(spark, X.remove_markup, text) == "თავი\nმზე ცის და მთა  ბმული."
    assert result(spark, X.is_redirect, "#REDIRECT [[ა]]") and not result(spark, X.is_redirect, None)


def test_markup_at_any_depth(spark):
    deep = 9
    text = "ა " + "{{x|" * deep + "y" + "}}" * deep + "{|\n" * deep + "z" + "\n|}" * deep + "{{a {| b {{c}} |} {{d}} }}" + "[[File:a|" * deep + "[[ბ]]" + "]]" * deep + "[[გ|" * deep + "დ" + "]]" * deep + " {{ე"
    assert result(spark, X.remove_markup, text) == "ა დ {{ე"
    assert result(spark, X.remove_markup, None) is None
