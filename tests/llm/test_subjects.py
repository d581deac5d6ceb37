from __future__ import annotations

import random

import numpy as np
import pytest

from marani.llm import subjects as S

TOPICS = {"science": ["ატომი", "სპექტრი"], "law": ["სასამართლო", "მოსამართლე"], "music": ["მელოდია", "სიმღერა"]}
MORE = {"science": ["კვარკი", "ფოტონი", "ველოსი"], "law": ["კანონი", "ფიცილი", "ბრალი"], "music": ["ნოტანი", "ფლეიტა", "ლადორი"]}
ENGLISH = {"science": ["atom", "quark"], "law": ["court", "verdict"], "music": ["song", "violin"]}
CASES = ["", "ს", "ის", "ით", "მა", "ზე", "თან", "ები", "ების"]
FILL = ["დიდი", "პატარა", "გზა", "სახლი", "ნახა", "იყო", "დღე"]


def word(r, topic):
    if r.random() < 0.2:
        return r.choice(ENGLISH[topic])
    w = r.choice(TOPICS[topic] + MORE[topic] * 2)
    return w.rstrip("იაო") + r.choice(CASES) if r.random() < 0.8 else w


def sentence(r, topic):
    words = [r.choice(FILL) for _ in range(6)] + ["ჟ" + "".join(r.choice("აბგდევზ") for _ in range(6))]
    if topic:
        words += [word(r, topic), word(r, topic)]
    r.shuffle(words)
    return " ".join(words) + r.choice([". ", "! ", "… ", "; "])


def corpus(seed, n):
    r = random.Random(seed)
    docs, truth = [], {}
    for d in range(n):
        main = r.choice([*TOPICS, None])
        other = r.choice([*TOPICS]) if main and r.random() < 0.2 else None
        topics = [main] * 3 + [other] * (2 if other else 0) + [None]
        own = [t for t in topics if t]
        truth[d] = {t for t in own if own.count(t) >= 0.25 * len(own)}
        docs.append((d, "".join(sentence(r, t) for t in topics)))
    return docs, truth


def test_held_out_accuracy(spark):
    docs, truth = corpus(1, 900)
    r = random.Random(2)
    labels = [(d, s if r.random() < 0.95 else "law") for d in range(0, 900, 5) for s in (truth[d] or {"none"})] + [(None, "law"), (3, None), (0, " Law ")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS subject", "1 AS labels", "2 AS hand")
    s = spark.createDataFrame([(k, TOPICS[k], ENGLISH[k][:1]) for k in TOPICS] + [(None, None, None)], "subject string, terms_ka array<string>, terms_en array<string>")
    l = spark.createDataFrame(labels, "doc_id long, subject string").selectExpr("*", "'a' AS text")
    found = {}
    for x in S.subject_areas(d, s, l).collect():
        found.setdefault(x["doc_id"], set()).add(x["subject"])
    hit = sum(len(found.get(k, set()) & truth[k]) for k in truth if k % 5)
    wrong = sum(len(found.get(k, set()) ^ truth[k]) for k in truth if k % 5)
    assert 2 * hit / (2 * hit + wrong) > 0.9


def test_edges(spark):
    docs, truth = corpus(3, 200)
    s = spark.createDataFrame([(k, TOPICS[k], ENGLISH[k]) for k in TOPICS], "subject string, terms_ka array<string>, terms_en array<string>")
    l = spark.createDataFrame([(d, x) for d in range(200) for x in truth[d]], "doc_id long, subject string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = S.train(d, s, l)
    long = "ატომი ატომს ნახა. " * 20_000
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "...;!?"), (4, "დიდი გზა."), (5, long), (6, "ატომი სპექტრს"), (6, "ატომი სპექტრს"), (None, "ატომი სპექტრს")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["subject"]) for r in S.assign(odd, model).collect())
    assert got == [(0, "science"), (5, "science"), (6, "science"), (6, "science")]
    assert S.assign(odd.limit(0), model).count() == 0
    assert S.subject_areas(d.limit(0), s, l).count() == 0
    assert S.subject_areas(odd, s, l.limit(0)).columns == ["doc_id", "subject"]


def test_every_subject_has_its_own_threshold():
    # Of 30 documents each, those of "b" score lower, and so do wrong sentences of "a"; "c" has no example.
    names = ["a", "b", "c"]
    model = S.Model(names, np.empty(0, np.int64), np.zeros((0, 3), np.float32), np.zeros(3, np.float32), np.zeros(3, np.float32))
    score = np.full((90, 3), -9, np.float32)
    score[:30, 0], score[30:60, 1], score[60:, 0] = 0.7, -0.95, -0.9
    given = np.zeros((90, 3), bool)
    given[:30, 0], given[30:60, 1] = True, True
    S._calibrate(model, score, np.arange(90), given, np.ones(90, bool), 90)
    found = S.shares(model.best(score), np.arange(90), 90, 3)
    assert model.threshold[0] > model.threshold[1] == model.threshold[2]
    assert (found[:30] == given[:30]).all() and not found[60:].any()


def test_shares_and_stems():
    subject, doc = np.array([0, 0, 0, 1, -1, 1]), np.array([0, 0, 0, 0, 0, 1])
    assert S.shares(subject, doc, 3, 2).tolist() == [[True, True], [False, True], [False, False]]
    subject = np.array([0, 0, 0, 0, 1])
    assert S.shares(subject, np.zeros(5, int), 1, 2).tolist() == [[True, False]]
    assert S.stem("ატომის") == S.stem("atomis") == S.stem("ატომებს") == S.stem("atomidan")
    assert S.stem("yველა") == S.stem("qvela")


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams(n):
    pieces = np.array([5, 6, -1, 7, 8, 9, -1, -1, 4])
    feature, sentence, count = S.rows_of(pieces, n)
    assert count == 4 and len(feature) == 6 + (3 if n > 1 else 0) + (1 if n > 2 else 0)
    assert sentence[:6].tolist() == [0, 0, 1, 1, 1, 3]
    assert S.rows_of(np.array([], np.int64), n)[2] == 0


def test_sample_is_bounded_in_words(spark, monkeypatch):
    docs, truth = corpus(3, 200)
    s = spark.createDataFrame([(k, TOPICS[k], ENGLISH[k]) for k in TOPICS], "subject string, terms_ka array<string>, terms_en array<string>")
    l = spark.createDataFrame([(d, x) for d in range(100) for x in truth[d]], "doc_id long, subject string")
    d = spark.createDataFrame([*docs, (10_000, "ატომი " * 40_000)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(S, "fit", lambda docs, *_: seen.append(docs))
    for most in (10**6, 600):
        monkeypatch.setattr(S, "SAMPLE_WORDS", most)
        S.train(d, s, l)
    whole, few = seen
    assert sum(len(p) for p, _, _ in whole) > 40_000 and 0 < sum(len(p) for p, _, _ in few) <= 600
    assert {(p.tobytes(), tuple(x or ())) for p, x, _ in few} <= {(p.tobytes(), tuple(x or ())) for p, x, _ in whole}
    assert all(x is not None for _, x, _ in few)  # labelled documents come first
