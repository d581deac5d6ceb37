from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from marani.operators import fields


def plain(field):
    """Values of a field without ambiguous numbers, letter by letter."""
    out, at = [], 0
    pairs = dict((q[0], q[1]) for q in ('""', "„“", "«»"))
    stops = set("|｜;；,，/／、､·・\t\n\r")
    while at < len(field):
        k = at
        while k < len(field) and field[k].isspace():
            k += 1
        if k < len(field) and field[k] in pairs:
            close, e, value = pairs[field[k]], k + 1, ""
            while e < len(field) and (field[e] != close or field[e + 1 : e + 2] == close):
                value += field[e]
                e += 2 if field[e] == close else 1
            rest = e + 1
            while rest < len(field) and field[rest].isspace() and field[rest] not in stops:
                rest += 1
            if e < len(field) and (rest >= len(field) or field[rest] in stops):
                out.append(value.strip())
                at = rest + 1
                continue
        e = at
        while e < len(field) and field[e] not in stops:
            e += 1
        out.append(field[at:e].strip())
        at = e + 1
    return [v for v in out if v]


def unpacked(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, keywords_ka string")
    found = {}
    for r in fields.unpack(df).collect():
        found.setdefault(r["row_id"], {})[r["pos"]] = r["keyword"]
    return {k: [v[n] for n in sorted(v)] for k, v in found.items()}, found


def test_against_plain(spark):
    rng = random.Random(9)
    words = ["მზე", "დიდი მთა", "თამაში-დრო", "Tbilisi", "ა​ბ", "x7"]
    rows = []
    for n in range(400):
        seps = rng.choices(["|", "; ", " , ", "/", "、", "·", "\t", "\n", "｜ "], k=rng.randint(1, 3))
        field = ""
        for _ in range(rng.randint(0, 7)):
            w = rng.choice(words)
            w = rng.choice([w, w, w, "", f'"{w}"', f'"{w}, {w}"', f"„{w}/{w}“", f"«{w}|{w}»", f'"{w} ""{w}"""'])
            field += w + rng.choice(seps)
        rows.append((n, field))
    got, places = unpacked(spark, rows)
    assert all(got.get(n, []) == plain(f) for n, f in rows)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


@pytest.mark.parametrize(
    ("field", "values"),
    [
        ("24/7", ["24/7"]),
        ("1,5 ლიტრი, მზე", ["1,5 ლიტრი", "მზე"]),
        ("word54/50/50", ["word54", "50/50"]),
        ("50/50,1,5 ლიტრი", ["50/50", "1,5 ლიტრი"]),
        ('"open|ბ', ['"open', "ბ"]),
        ('ა "ბ" გ|დ', ['ა "ბ" გ', "დ"]),
        (" ; ,", []),
        ("", []),
    ],
)
def test_parse(field, values):
    assert [v for v, _ in fields.parse(field)] == values


def test_numbers_are_kept(spark):
    rows = [(n, f) for n, f in enumerate(["50/50| მზე", "მზე/50/50/ცა", "24/7", "ცა, 24/7", "3,14; მზე", "3,14"])]
    got, _ = unpacked(spark, rows)
    assert got == {0: ["50/50", "მზე"], 1: ["მზე", "50/50", "ცა"], 2: ["24/7"], 3: ["ცა", "24/7"], 4: ["3,14", "მზე"], 5: ["3,14"]}


def test_known_values_stay_whole(spark):
    names = ["კონსტანტინოპოლელი, ალექსანდრე", "მელიქიშვილიანთკარელი, გიორგი", "წერეთლისციხისთავი, თამარხათუნი"]
    rows = [(n, f'"{names[n % 3]}"') for n in range(60)] + [(100, "; ".join(names))]
    got, _ = unpacked(spark, rows)
    assert got[100] == names


def test_quoted_copies_keep_a_value_whole(spark):
    field = "aaaaaaaaaa, bbbbbbbbbb, cccccccccc"
    got, _ = unpacked(spark, [(n, f'"{field}"') for n in range(200)] + [(300, field), (301, field.replace("b", "d"))])
    assert got[300] == [field] and got[301] == ["aaaaaaaaaa", "dddddddddd", "cccccccccc"]


def cheapest(rows):
    """The values of each field by all its dialects, with the bits of every one worked out plainly."""
    first = {n: [v for v, _ in fields.parse(f)] for n, f in rows}
    counts = Counter(v for values in first.values() for v in values)
    total = sum(counts.values())
    price = {}
    for kind in [*fields.SEPARATORS, fields._quote_marks]:
        outside = sum(f.count(c) for _, f in rows for c in kind) - sum(v.count(c) for values in first.values() for v in values for c in kind)
        price |= dict.fromkeys(kind, math.log2(fields.BEFOREHAND + outside))
    out = {}
    for n, f in rows:
        best = None
        for place, dialect in enumerate(fields.dialects(f)):
            values = fields.parse(f, *dialect)
            bits = fields.CHOICE * (1 + math.log2(1 + place))
            for v, quoted in values:
                free = "" if quoted else fields._number.sub("0", v)
                letters = fields.NEW_VALUE + fields.LETTER * (len(v) - sum(c in price for c in free)) + sum(price.get(c, 0) for c in free)
                known = counts[v] - first[n].count(v)
                bits += round(min(letters, math.log2(total / known) + 1) if known else letters, 6)
            if best is None or bits < best[0] - 1e-9:
                best = bits, [v for v, _ in values]
        out[n] = best[1]
    return out


def test_against_all_dialects(spark):
    rng = random.Random(12)
    words = ["ab", "cd efgh", "ij-kl", "12", "3,5", "mnopqrstuv, wxyz", "x/y"]
    rows = []
    for n in range(300):
        sep = rng.choice(["|", "; ", ", ", "/"])
        rows.append((n, sep.join(rng.choice([w, w, f'"{w}"', f"„{w}“"]) for w in rng.choices(words, k=rng.randint(1, 5)))))
    got, _ = unpacked(spark, rows)
    assert got == cheapest(rows)


def test_edges(spark):
    long = "|".join(f"სიტყვა{n}" for n in range(20_000))
    rows = [(1, None), (2, ""), (3, " ;,"), (4, "ა|ბ"), (4, "ა|ბ"), (None, "გ"), (5, long)]
    df = spark.createDataFrame(rows, "row_id long, keywords_ka string").selectExpr("*", "1 AS row", "'x' AS field", "2 AS pos", "3 AS values", "4 AS id")
    got = fields.unpack(df).collect()
    assert sorted((r["row_id"], r["pos"], r["keyword"]) for r in got if r["row_id"] == 4) == [(4, 0, "ა"), (4, 0, "ა"), (4, 1, "ბ"), (4, 1, "ბ")]
    assert [r["keyword"] for r in got if r["row_id"] is None] == ["გ"]
    assert sum(r["row_id"] == 5 for r in got) == 20_000 and not any(r["row_id"] in (1, 2, 3) for r in got)
    assert fields.unpack(df.limit(0)).count() == 0
