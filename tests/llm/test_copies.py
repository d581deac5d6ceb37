from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from marani.llm import copies

SAME = [
    ("მზე ანათებს დღეს.", " „ᲛᲖᲔ“ —  ანათებს,\n დღეს…"),
    ("სახელი: ა ბ; კოდი: 5", "კოდი – 5 | სახელი – ᲐᲑ ".replace("ᲐᲑ", "Ა Ბ")),
    ("სახელი: ა; კოდი: 5.", "კოდი=5\nსახელი=ა"),
    ("a: x, b: y", "b : y • a : x"),
    ("5 - 6", "5 6"),
    ("ΣΑΣ ΟΔΟΣ", "σας οδος"),
]
OTHER = [("მზე ანათებს", "ანათებს მზე"), ("კოდი: 5; ენა: 6", "კოდი: 6; ენა: 5"), ("1,5", "15"), ("ა ბ", "აბ"), ("ა", "ა ა"), ("სახელი: ა; კოდი: 5", "სახელი: ა; კოდი: 5; ენა: ბ")]


def forms(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    return df.select(*(f(F.col(c)).alias(c + n) for c in "ab" for n, f in (("w", copies.words_only), ("f", copies.fields_of)))).collect()


def test_forms(spark):
    same = lambda r: r["aw"] == r["bw"] or (r["af"] is not None and r["af"] == r["bf"])
    assert all(map(same, forms(spark, SAME)))
    assert not any(map(same, forms(spark, OTHER)))
    none = spark.createDataFrame([(1, None), (2, ""), (3, " .,!…"), (4, "«»")], "id long, text string")
    assert copies.keyed(none).count() == 0


def test_one_wording_as_record_and_prose(spark):
    # Rows 1 and 2 have the same words, 2 and 3 the same fields, 3, 4 and 5 the same words.
    texts = ["a b c d", "a: b, c: d", "c: d; a: b", "c d a b", "c d: a; b", "a b d c"]
    rows = [(n + 1, t) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, text string")
    assert {tuple(r) for r in copies.repeats(df).collect()} == {(1, 2), (1, 3), (1, 4), (1, 5)}
    linked = [(1, "a b: c, d: e"), (2, "a: b c, d: e"), (3, "d: e; a b: c"), (4, "d: e; a: b c"), (5, "d e a b c"), (6, "a: c b, d: e")]
    df = spark.createDataFrame(linked, "id long, text string")
    assert {tuple(r) for r in copies.repeats(df).collect()} == {(1, 2), (1, 3), (1, 4), (1, 5)}
    assert {tuple(r) for r in copies.collapse(df).collect()} == {(1, 5), (6, 1)}


@pytest.mark.parametrize("least", [10_000, 40])
def test_groups(spark, monkeypatch, least):
    monkeypatch.setattr(copies, "ROWS_OF_A_KEY", least)  # the second time with heavy keys
    r = random.Random(3)
    texts = [f"სიტყვა {r.choice([1] * 20 + list(range(60)))}" for _ in range(900)] + [None, "", "?!"]
    rows = [(n, r.choice([t, t and t.upper(), t and f" {t}!"])) for n, t in enumerate(texts)]
    by = collections.defaultdict(list)
    for n, t in rows:
        if t and any(c.isalnum() for c in t):
            by[t.strip(" !").lower()].append(n)
    df = spark.createDataFrame(rows, "id long, text string").repartition(5).selectExpr("*", "1 AS h1", "2 AS form", "3 AS copies")
    assert {(x["first_id"], x["copies"]) for x in copies.collapse(df).collect()} == {(min(v), len(v)) for v in by.values()}
    assert {tuple(x) for x in copies.repeats(df).collect()} == {(min(v), n) for v in by.values() for n in v if n != min(v)}
    keys = copies.keyed(df)
    heavy = copies.heavy_keys(keys)
    if least == 40:
        assert {x["count"] for x in heavy.collect()} == {len(v) for v in by.values() if len(v) >= 40}
    else:
        assert heavy is None


def test_heavy_keys_are_exact(spark):
    r = random.Random(5)
    rows = [(n, int(r.paretovariate(0.6)) % 5000, 0) for n in range(20_000)]
    df = spark.createDataFrame(rows, "id long, h1 long, h2 long").repartition(8)
    count = collections.Counter(k for _, k, _ in rows)
    for least in (1000, 100, 20):
        found = copies.heavy_keys(df, least)
        assert {(x["h1"], x["count"]) for x in found.collect()} == {(k, n) for k, n in count.items() if n >= least}


def test_edges(spark):
    long = "სიტყვა " * 50_000
    rows = [(None, "ა"), (3, "ა"), (3, "ა"), (None, "ბ"), (5, long), (6, long.upper())]
    df = spark.createDataFrame(rows, "id long, text string")
    assert {tuple(r) for r in copies.collapse(df).collect()} == {(3, 3), (None, 1), (5, 2)}
    assert [tuple(r) for r in copies.repeats(df).collect()] == [(5, 6)]
    assert copies.collapse(df.limit(0)).count() == 0 == copies.repeats(df.limit(0)).count()
