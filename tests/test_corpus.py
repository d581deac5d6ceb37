from __future__ import annotations

import random

from pyspark.sql import functions as F

from marani.operators import contexts, corpus, morph, vocab


def test_first_and_dense_ids(spark):
    rng = random.Random(1)
    rows = [(n, rng.choice("abcdefg") if n % 5 else "hot") for n in range(500)] + [(1000, None), (1001, None)]
    df = spark.createDataFrame(rows, "k int, text string")
    first = {}
    for k, t in rows:
        first[t] = min(first.get(t, k), k)
    for parts in (1, 7):
        once = corpus.first_of(df.repartition(parts), "text", ["k"])
        assert {r["text"]: r["k"] for r in once.collect()} == first
        numbered = corpus.dense_ids(df.repartition(parts), ["k"]).orderBy("id").collect()
        assert [r["id"] for r in numbered] == list(range(len(rows))) and [r["k"] for r in numbered] == sorted(k for k, _ in rows)
    assert corpus.dense_ids(df.limit(0), ["k"]).count() == 0


def test_key_change_groups(spark):
    rows = [("p", n, k) for n, k in enumerate("aabbaac")] + [("q", 0, None), ("q", 1, None), ("q", 2, "a")]
    df = spark.createDataFrame(rows, "p string, n int, k string")
    got = corpus.key_change_groups(df, ["p"], ["n"], ["k"]).orderBy("p", "n").collect()
    assert [r["group_ix"] for r in got] == [0, 0, 1, 1, 2, 2, 3, 0, 0, 1]


def test_verse(spark):
    lines = [(1, '"აა ბბ გგ" ', "t1", "1", "1"), (2, "", "t1", "1", "1"), (3, "დდ ეე", "t1", "1", "1"), (4, " ", "t1", "1", "2"), (5, "ვ ზ", "t1", "1", "1"), (6, "თ ი", "t2", "2", "1")]
    df = spark.createDataFrame(lines, "id long, line string, chapter string, chapter_id string, strophe_id string")
    got = corpus.verse_sentences(df).orderBy("first_line").collect()
    assert [(r["article"], r["text"]) for r in got] == [("t1", "აა ბბ გგ დდ ეე"), ("t1", "ვ ზ"), ("t2", "თ ი")]


def test_runs_over_all_lines(spark):
    rng = random.Random(3)
    rows = [(n, f"ა{n}", *((None, "1") if n % 50 == 7 else (rng.choice("AB"), rng.choice("12")))) for n in range(400)]
    rows += [(400 + n, f"ბ{n}", "C", "9") for n in range(300)]  # one run over several partitions
    df = spark.createDataFrame(rows, "id long, line string, chapter_id string, strophe_id string").withColumn("chapter", F.col("chapter_id"))
    want, last = [], None
    for n, line, c, s in rows:
        want = want if last == (c, s) else [*want, [n, c, []]]
        want[-1][2].append(line)
        last = (c, s)
    for parts in (1, 6):
        spark.conf.set("spark.sql.adaptive.enabled", str(parts == 1).lower())  # without it the lines stay in several ranges
        got = corpus.verse_sentences(df.repartition(parts), min_ratio=0).orderBy("first_line").collect()
        assert [(r["first_line"], r["chapter_id"], r["text"].split()) for r in got] == [tuple(w) for w in want]
        assert [r["group_ix"] for r in got] == list(range(len(want)))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    again = [(1, "ა", "A"), (2, "ბ", "B"), (3, "გ", "A")]
    df = spark.createDataFrame(again, "id long, line string, chapter_id string").selectExpr("*", "chapter_id AS chapter", "'1' AS strophe_id")
    assert [r["text"] for r in corpus.verse_sentences(df).orderBy("first_line").collect()] == ["ა", "ბ", "გ"]
    assert corpus.verse_sentences(df.limit(0)).count() == 0


def test_html():
    page = """<html><body><p>one <b>two</b><sup>9</sup></p><div class="infobox"><p>no</p></div><table><p>no</p></table>
    <ol class="references"><li><p>no</p></li></ol><p></p><p>three<p>four<br>five</body></html>"""
    assert corpus.paragraphs_of(page) == ["one two", "three", "four five"]
    assert corpus.paragraphs_of("<p>no body</p>") == [] == corpus.paragraphs_of(None)


def test_frequent_tokens(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a", "x"]), (2, ["b", "c"]), (3, []), (4, ["c", "z"])], "id int, tokens array<string>")
    assert {r["id"]: r["tokens"] for r in corpus.frequent_tokens(df, "id", "tokens").collect()} == {1: ["a", "b", "a"], 2: ["b", "c"]}


def occurrences(seed=2, n=3000):
    rng = random.Random(seed)
    return sorted({(rng.choice(["x"] * 5 + list("abcdef")), rng.randrange(200), rng.randrange(30), rng.choice(["f1", "f2", "f3"])) for _ in range(n)})


def test_caps(spark):
    rows = occurrences()
    df = spark.createDataFrame(rows, "lemma string, sid int, pos int, form string").withColumn("article", (F.col("sid") % 9).cast("string"))
    one, other = (sorted(map(tuple, vocab.capped_occurrences(df.repartition(p), 50).drop("article").collect())) for p in (1, 7))
    assert one == other and set(one) <= set(rows)
    for lemma in {r[0] for r in rows}:
        assert sum(r[0] == lemma for r in one) == min(50, sum(r[0] == lemma for r in rows))
    drawn = {}
    keyed = df.withColumn("k", vocab.draw_key(vocab.SEED, "lemma", "sid", "pos")).collect()
    for r in sorted(keyed, key=lambda r: (r["lemma"], r["k"], r["sid"], r["pos"])):  # the greedy loop
        taken = drawn.setdefault(r["lemma"], [])
        if len(taken) < 8 and sum(t["article"] == r["article"] for t in taken) < 2:
            taken.append(r)
    want = sorted((r["lemma"], r["sid"], r["pos"]) for t in drawn.values() for r in t)
    got = vocab.sample_contexts(df, 2, 8, key="lemma").collect()
    assert sorted((r["lemma"], r["sid"], r["pos"]) for r in got) == want


def test_vocabulary(spark):
    words = ["მზე"] * 9 + ["და"] * 12 + ["ცა"] * 8 + ["ა"] * 20 + ["მთა"] * 3
    df = spark.createDataFrame([(w, n, 0, w) for n, w in enumerate(words)], "lemma string, sid int, pos int, form string")
    listed = spark.createDataFrame([("ᲓᲐ",)], "word string")
    got = vocab.select_vocabulary(vocab.token_frequency(df, "lemma"), vocab.dominant_form(df), listed).orderBy("i").collect()
    assert [(r["i"], r["word"], r["freq"]) for r in got] == [(0, "მზე", 9), (1, "ცა", 8)]
    import hashlib

    v = spark.createDataFrame([(1, "ბ"), (0, "ა")], "i int, word string")
    assert vocab.vocabulary_hash(v).first()[0] == hashlib.sha256("ა\nბ".encode()).hexdigest()
    assert vocab.dominant_form(spark.createDataFrame([("l", 1, 1, "b"), ("l", 0, 5, "a")], "lemma string, sid int, pos int, form string")).first()["word"] == "a"


def test_collapse(spark):
    schema = "i int, word string, lemma string, freq long, occ array<struct<sid:long,form:string>>"
    rows = [(0, "დედა", "დედა", 5, [(1, "დედა")]), (1, "დედამ", "x", 7, [(2, "დედამ"), (3, "დედამ")]), (2, "მთა", "y", None, None), (3, "მთის", None, 1, [])]
    got = {r["lemma"]: r for r in vocab.collapse(spark.createDataFrame(rows, schema)).collect()}
    assert (got["დედ"]["word"], got["დედ"]["freq"], got["დედ"]["src_i"], got["დედ"]["i"]) == ("დედამ", 12, 1, 0)
    assert [o["sid"] for o in got["დედ"]["occ"]] == [2, 3, 1]
    assert vocab.collapse(spark.createDataFrame(rows, schema), cap=2).where("lemma = 'დედ'").first()["occ"].__len__() == 2
    assert got["მთა"]["occ"] == []


def test_wordcount(spark):
    df = spark.createDataFrame([(["a", "bb"],), (["a"],), ([],)], "t array<string>")
    s = vocab.wordcount_stats(df, "t").first().asDict()
    assert s == {"max_group_length": 2, "max_word_length": 2, "min_word_length": 1, "total_words": 3, "total_groups": 3, "total_unique_words": 2}


AFFIXES = """FLAG long
FORBIDDENWORD &!
NEEDAFFIX &v
CIRCUMFIX &x
SFX NS Y 1
SFX NS 0 ს .
SFX VC Y 1
SFX VC ი ეთ/&xpA [^ა]ი
PFX pA Y 1
PFX pA 0 სა/&x .
PFX pB Y 1
PFX pB 0 უ .
"""


def test_affixes(spark):
    a = morph.parse_affixes(AFFIXES)
    assert (a.circumfix, a.need_affix, a.forbidden) == ("&x", "&v", "&!") and len(a.rules) == 4
    assert set(morph.flags_of("ABCD")) == {"AB", "CD"} and morph.flags_of("1,22", "num") == ["1", "22"] and morph.flags_of("ab", "short") == ["a", "b"]
    assert morph.apply_suffix("კატა", "", "ს") == "კატას" and morph.apply_suffix("კატა", "ი", "ს") is None
    stems = [("კატა", ["NS"]), ("ქვი", ["VC", "pB"]), ("სახლი", None), ("მდე", ["NS", "&v"]), ("ბნე", ["&!"]), ("", ["NS"]), (None, None)]
    df = spark.createDataFrame(stems, "stem string, flags array<string>")
    got = {(r["stem"], r["form"]) for r in morph.expand(df, a).collect()}
    assert got == {("კატა", "კატა"), ("კატა", "კატას"), ("ქვი", "ქვი"), ("ქვი", "საქვეთ"), ("ქვი", "უქვი"), ("სახლი", "სახლი"), ("მდე", "მდეს")}
    pairs = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "b"), ("c", None)], "form string, lemma string")
    assert [tuple(r) for r in vocab.form_to_lemma(pairs).collect()] == [("a", "x")]


def test_contexts(spark):
    rows = [(0, "მზე", "მზე ანათებს დღეს"), (0, "მზე", "დღეს მზე"), (1, "ცა", "სხვა")]
    made = contexts.embed(contexts.inputs(spark.createDataFrame(rows, "i int, form string, text string")), contexts.HashedNgrams(64), 64).collect()
    assert [(r["i"], r["n_used"]) for r in made] == [(0, 2)] and abs(sum(x * x for x in made[0]["vec"]) - 1) < 1e-9
    assert contexts.layer_index("last", 0.5, 24) is None and contexts.layer_index(None, 0.5, 25) == 12 and contexts.layer_index(None, 0.0, 9) == 1
    assert contexts.row_seed(5, 0) == 5
