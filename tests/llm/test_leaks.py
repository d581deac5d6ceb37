from __future__ import annotations

import random

import pytest

from marani.llm import leaks
from marani.llm.words import WORDS, WordHashes, hashed, one_form, plain

rng = random.Random(4)
VOCABULARY = ["".join(rng.choice("აბგდევზთიკლმნო") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
COMMON = ["იყო", "და", "დიდი", "რომ"]


def prose(r, n):
    return [r.choice(COMMON) if r.random() < 0.3 else r.choice(VOCABULARY) for _ in range(n)]


def edited(r, words, edits):
    """Words with so many edits, no two of them beside each other and none at the ends."""
    out = list(words)
    for at in sorted(r.sample(range(1, len(words) - 1, 2), edits), reverse=True):
        kind = r.choice(["replace", "drop", "add"])
        if kind == "replace":
            out[at] = "შეცვლილი" + str(r.random())[2:6]
        elif kind == "drop":
            del out[at]
        else:
            out.insert(at, "დამატებული" + str(r.random())[2:6])
    return out


def disguised(r, words):
    text = "".join(r.choice([" ", "  ", "\n", ", ", " - "]) + r.choice([w, w.upper(), w.replace("ყ", "y"), f"<b>{w}</b>", f"[[{w}]]", w[:1] + "​" + w[1:], f"{w[:1]}-\n{w[1:]}" if len(w) > 2 else w]) for w in words)
    return text


def holds(passage, text):
    """Whether a run of the passage of 16 words or more stands in the text with at most one edit in seven words: by all starts."""
    a, b = [one_form(w) for w in passage], [one_form(w) for w in WORDS.findall(plain(text))]
    most = len(a) // 7
    for i in range(len(a) - 15):
        for j in range(len(b)):
            if a[i] != b[j]:
                continue
            row = {0: [j + k for k in range(most + 1)]}
            # Least edits to align a[i:x] with b[j:y], by rows of the distance table.
            prev = list(range(len(b) - j + 1))
            for x in range(1, len(a) - i + 1):
                cur = [x]
                for y in range(1, min(len(b) - j, x + most + 1) + 1):
                    cur.append(min(prev[y] + 1 if y < len(prev) else 99, cur[y - 1] + 1, prev[y - 1] + (a[i + x - 1] != b[j + y - 1]) if y - 1 < len(prev) else 99))
                if x >= 16 and min(cur) <= x // 7:
                    return True
                prev = cur
            del row
    return False


def test_search_finds_all():
    r = random.Random(7)
    passages = [prose(r, r.randint(18, 50)) for _ in range(40)]
    memo = WordHashes()
    items = leaks.Items([(n, hashed(p, memo).astype("i8").tolist()) for n, p in enumerate(passages)])
    texts, planted, near = [], set(), 0
    for d in range(300):
        words = prose(r, r.choice([0, 5, 40, 400]))
        kind = r.random()
        if kind < 0.6:
            n = r.randrange(len(passages))
            size = r.randint(16, len(passages[n]))
            start = r.randint(0, len(passages[n]) - size)
            part = edited(r, passages[n][start : start + size], r.randint(0, size // 7 - (size % 7 == 0)))
            at = r.randint(0, len(words))
            texts.append(disguised(r, words[:at]) + " " + disguised(r, part) + " " + disguised(r, words[at:]))
            planted.add((d, n))
        elif kind < 0.8:
            n = r.randrange(len(passages))
            texts.append(" ".join([*words, *passages[n][:11], *prose(r, 30)]))
            near += 1
        else:
            texts.append(" ".join(words))
    found = set(leaks.search(items, texts, memo))
    assert planted <= found
    assert all(holds(passages[n], texts[d]) for d, n in found - planted)
    assert near > 20 and len(found - planted) < 5


def test_bounds():
    sizes = [leaks.functions_for(s) for s in (8, 15, 30)]
    assert sizes == sorted(sizes) and all((1 - leaks.KEPT / (14 + 30 - leaks.KEPT)) ** f <= leaks.MISS for f in sizes[-1:])


def test_table(spark, monkeypatch):
    r = random.Random(8)
    instruction = "წაიკითხეთ ეს ტექსტი და უპასუხეთ კითხვას".split()
    passages = {n: prose(r, 30) for n in range(12)}
    items = [(n, " ".join((instruction if n % 2 else []) + p)) for n, p in passages.items()] + [(50, None), (51, ""), (52, "ცოტა სიტყვა"), (None, " ".join(prose(r, 20)))]
    items += [(60, items[1][1])]  # the same text again
    long = " ".join(prose(r, 60_000) + passages[3])
    docs = [(1, " ".join(passages[0])), (2, " ".join(passages[1])), (2, " ".join(passages[1])), (3, None), (4, ""), (5, long), (6, " ".join(instruction * 3)), (7, " ".join(passages[1]))]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS doc", "3 AS item")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS words", "3 AS row")
    want = {(1, 0), (2, 1), (2, 60), (5, 3), (7, 1), (7, 60)}
    got = leaks.leaked(d, i).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    monkeypatch.setattr(leaks, "ITEM_WORDS_AT_ONCE", 60)  # signatures are joined
    assert sorted(map(tuple, leaks.leaked(d, i).collect())) == sorted(want)
    monkeypatch.setattr(leaks, "ROWS_OF_A_SIGNATURE", 1)  # and salted
    assert sorted(map(tuple, leaks.leaked(d, i).collect())) == sorted(want)
    assert leaks.leaked(d.limit(0), i).count() == 0 == leaks.leaked(d, i.limit(0)).count()


def test_instruction_only(spark):
    r = random.Random(9)
    instruction, other = "read the passage and answer the question below".split(), "read the passage and choose one of the four answers that follow it".split()
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    passage, copied, under = fresh(30), fresh(40), fresh(30)
    want = {n: ["the", *fresh(30)] for n in range(4)} | {n: ["often", *fresh(30)] for n in range(4, 7)} | {n: fresh(30) for n in range(7, 20)}
    want |= {n: under + fresh(12) for n in range(20, 24)}  # questions about one passage after the instruction
    items = {n: instruction + w for n, w in want.items()}
    want |= {n: fresh(30) for n in range(30, 50)}
    items |= {n: other + want[n] for n in range(30, 50)}
    # A longer instruction begins with a whole shorter one.
    want |= {n: fresh(30) for n in range(50, 60)}
    items |= {n: [*instruction, "in", "one", "sentence", "of", "ten", "words"] + want[n] for n in range(50, 60)}
    bare = {n: passage + fresh(12) for n in range(60, 66)}  # questions about one passage
    bare |= {n: copied[: 8 + n - 70] + fresh(1) + copied[9 + n - 70 :] for n in range(70, 76)}  # near copies
    want, items = want | bare, items | bare
    rows = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    memo = WordHashes()
    got = {x["item"]: x["words"] for x in leaks.passages(rows).collect()}
    assert {n for n in want if got[n] != hashed(want[n], memo).astype("i8").tolist()} == set()
    docs = spark.createDataFrame([(n, " ".join(want[n][:16])) for n in (0, 5, 20, 60, 70)] + [(100, " ".join(instruction + want[0][:9]))], "doc_id long, text string")
    found = {tuple(x) for x in leaks.leaked(docs, rows).collect()}
    assert {(0, 0), (5, 5), (20, 20), (20, 23), (60, 60), (60, 65), (70, 70)} <= found and not any(d == 100 for d, _ in found)


@pytest.mark.parametrize("tag", ['<ref name="a" group="%s">' % ("word " * 30), "<a href=https://example.org/%s>" % ("one/two-" * 30), '<div class="a b"\n  id="c"\n  hidden style=\'%s\' />' % ("x: y; " * 20), "<https://example.org/%s>" % ("one/two-" * 30), "<!-- %s\n-->" % ("word " * 30), "</div\n>"])
def test_long_tags(tag):
    r = random.Random(10)
    passage = prose(r, 30)
    memo = WordHashes()
    items = leaks.Items([(0, hashed(passage, memo).astype("i8").tolist())])
    text = " ".join([*passage[:8], tag, *passage[8:16]])
    assert WORDS.findall(plain(text)) == passage[:16] and leaks.search(items, [text], memo) == [(0, 0)]
    prosaic = "a <b " + " and ".join(passage) + ", so that x = y and c> d"
    assert WORDS.findall(plain(prosaic)) == WORDS.findall(prosaic)


@pytest.mark.parametrize("items", [2, 3, 5])
def test_questions_about_one_passage(spark, items):
    r = random.Random(11)
    fresh = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    passage = fresh(45)
    rows = spark.createDataFrame([(n, " ".join(passage + fresh(9))) for n in range(items)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(fresh(20) + passage + fresh(10)))], "doc_id long, text string")
    assert {tuple(x) for x in leaks.leaked(docs, rows).collect()} == {(1, n) for n in range(items)}


@pytest.mark.parametrize(("markup", "shown"), [("[x](https://a.b/c/d/e/f)", "x"), ('[x](https://a.b/c_(d)/e "a title here")', "x"), ("[https://a.b/c/d x]", "x"), ("[[one two three|x]]", "x"), ("{{one two three}}", ""), ("f(x)[1](y z)", "f x 1 y z"), ("[[one two]]", "one two")])
def test_links(markup, shown):
    assert WORDS.findall(plain(f"a {markup} b")) == ["a", *shown.split(), "b"]


@pytest.mark.parametrize(("a", "b"), [("ᲐᲑ", "აბ"), ("Ｆull", "full"), ("ѕеа", "sea"), ("ყველა", "yველა"), ("é", "é")])
def test_one_form(a, b):
    assert one_form(a) == one_form(b)
