from __future__ import annotations

import random

import pytest

from marani.llm import lookalike as L
from marani.llm.words import CLASSES, one_form

MODEL = L.Model(dict(__import__("collections").Counter(b for t in ["ყველა ყოველი მთავარი ყურძენი დიდი", "yellow seaside export copy jolly window hybrid parks cafe quad vivid voice"] for b in L.bigrams(t))))


def look(text):
    return L.one_look(text, L.Forms(MODEL))


@pytest.mark.parametrize(
    ("written", "clean"),
    [
        ("уველა", "ყველა"),
        ("γოველი", "ყოველი"),
        ("ѕеаѕіdе", "seaside"),
        ("νісаνохе", "vicavoxe"),
        ("ｅｘｐｏｒｔ", "export"),
        ("ყვე​ლ⁠ა", "ყველა"),
        ("დიდი მთა", "დიდი მთა"),
        ("café", "café"),
        ("cаfе́", "café"),
        ("ა｜ბ", "ა|ბ"),
    ],
)
def test_one_look(written, clean):
    assert look(written) == clean


@pytest.mark.parametrize(("a", "b"), [("ᲧᲕᲔᲚᲐ", "ყველა"), ("cafe", "café"), ("a  b", "a b"), ("a,b", "a b"), ("Seaside", "seaside"), ("ა", "ბ")])
def test_visible_differences_stay(a, b):
    assert look(a) != look(b)


def test_form_depends_on_look_only():
    rng = random.Random(1)
    for _ in range(300):
        classes = [rng.choice(CLASSES) for _ in range(rng.randint(1, 8))]
        seen = {look("".join(rng.choice(c) for c in classes)) for _ in range(6)}
        assert len(seen) == 1


@pytest.mark.parametrize(("a", "b"), [("ꓐook", "Book"), ("Ꭺpple", "Apple"), ("ⲟne", "one")])
def test_further_scripts(a, b):
    assert look(a) == look(b) and one_form(a) == one_form(b)


def best_by_all_paths(run):
    import itertools

    def score(path):
        s, last = 0.0, ""
        for c in path:
            same = not last or L.script(last) == L.script(c)
            before = last if same else ""
            s += MODEL.step(before, c) - (0 if same else L.CHANGE)
            last = c
        return s + MODEL.step(last, "")

    return max(score(p) for p in itertools.product(*(L._class_of.get(c, (c,)) for c in run))), score


def test_viterbi_is_best():
    rng = random.Random(2)
    for _ in range(60):
        run = "".join(rng.choice("ყveolaspcxთდ") for _ in range(rng.randint(1, 6)))
        top, score = best_by_all_paths(run)
        assert abs(score(L.best_path(run, MODEL)) - top) < 1e-6


def test_pairs(spark, monkeypatch):
    monkeypatch.setattr(L, "PAIRS_AT_ONCE", 7)  # looks that many rows share are salted
    rows = [("word", n, t) for n, t in enumerate(["ყველა", "уველა", "ყველა", "ᲧᲕᲔᲚᲐ", None, "", " ", " ", "ab", "а​b"])]
    rows += [("word", None, "уველა"), ("keywords_ka", 0, "yველა"), ("keywords_ka", 1, ";,"), ("keywords_ka", 2, "；,"), ("word", 0, "ყველა")]
    rows += [("keywords_ka", 100 + n, "hot" + "​" * (n % 3)) for n in range(40)]
    df = spark.createDataFrame(rows, "field string, key long, text string").selectExpr("*", "1 AS n", "2 AS form", "3 AS h1")
    got = [tuple(r) for r in L.look_alike_pairs(df).collect()]
    hot = {("keywords_ka", a, b) for a in range(100, 140) for b in range(a + 1, 140) if a % 3 != b % 3 and (a - 100) % 3 != (b - 100) % 3}
    assert set(got) == {("word", 0, 1), ("word", 1, 2), ("word", 8, 9)} | hot
    monkeypatch.setattr(L, "ROWS_OF_A_LOOK", 5)  # hot looks are joined apart
    assert sorted(map(tuple, L.look_alike_pairs(df).collect())) == sorted(got)
    classes = [tuple(r) for r in L.look_alike_classes(df).collect()]
    want = [("word", k, 0, 4) for k in (0, 0, 1, 2)] + [("word", 8, 8, 2), ("word", 9, 8, 2)] + [("keywords_ka", k, 100, 40) for k in range(100, 140)]
    assert sorted(classes) == sorted(want)
    monkeypatch.setattr(L, "ROWS_OF_A_LOOK", 100_000)
    assert sorted(tuple(r) for r in L.look_alike_classes(df).collect()) == sorted(want)
    assert L.look_alike_pairs(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "ყ" * 100_000), (2, None), (3, "")], "k int, text string")
    assert [r["form"] for r in L.forms(long, MODEL, keep=["k"]).orderBy("k").collect()] == ["ყ" * 100_000, None, ""]
    assert all(L.fold(letter) == letter for c in CLASSES for letter in c)
