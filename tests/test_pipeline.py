from __future__ import annotations

import json
import zipfile

import pytest
import yaml

from marani.__main__ import main
from marani.operators import contexts
from marani.plans import pipeline
from marani.sources import readers, sinks


def test_text_to_dataset(spark, tmp_path):
    words = "მზე მთა ზღვა ტბა წიგნი სახლი ქარი ხე გზა ცხენი".split()
    docs = [(d, " ".join(f"{words[(d + k) % 10]} {words[(d * k) % 10]} {words[k % 10]} {words[(d + 3) % 10]}{'ით' * (k % 2)}." for k in range(8)), f"t{d % 7}") for d in range(60)]
    df = spark.createDataFrame(docs + [(99, None, None), (98, docs[0][1], "t")], "doc_id long, text string, title string")
    s = pipeline.Settings(min_occurrences=3, dimensions=32, umap={"n_neighbors": 4, "min_dist": 0.1, "seed": 1, "epochs": 20})
    sentences = pipeline.build_sentences(df, s)
    texts = [r["text"] for r in sentences.collect()]
    assert len(texts) == len(set(texts)) and sorted(r["id"] for r in sentences.collect()) == list(range(len(texts)))
    assert {r["article"] for r in pipeline.build_sentences(df, s, limit=2).collect()} <= {"t0", "t1"}
    v = pipeline.build_vocabulary(sentences, None, spark.createDataFrame([("გზა",)], "word string"), s).cache()
    assert "გზა" not in {r["word"] for r in v.collect()} and v.count() >= 9
    vectors = pipeline.build_vectors(v, sentences, contexts.HashedNgrams(64), 64, s).cache()
    config = {"id": "a", "corpus": "c", "reduce": {"dim128_method": "mrl", "umap": {"n_neighbors": 4, "min_dist": 0.1, "seed": 1}}, "neighbors": {"k": 5}}
    out = str(tmp_path / "dist")
    meta = pipeline.publish(out, config, v, vectors)
    assert meta["count"] == v.count() and meta["displacement"]["median"] is None
    probes = spark.createDataFrame([("მზე", [w for w in words if w != "მზე"], [])], "word string, expected array<string>, forbidden array<string>")
    assert pipeline.evaluate(spark, out, [meta], {"c": probes}).collect() == []
    assert meta["dims_i8"] == 64
    listed = spark.createDataFrame([("მზე",)], "word string")
    assert {r["check"] for r in pipeline.evaluate(spark, out, [meta], {"c": probes}, listed, {"c": 1.1}).collect()} == {"listed_word", "probes"}
    broken = meta | {"count": meta["count"] + 1, "aligned_group": "g", "displacement": {"median": 0.9, "p95": 1.0}}
    assert {r["check"] for r in pipeline.evaluate(spark, out, [broken], {}).collect()} >= {"label_count", "file_size", "displacement", "neighbour_records"}
    (tmp_path / "e.csv").write_text("emoji,keywords_ka\n🐩,მზე| უცხო |მთა|ტბა\n🥑,ტბა ზღვა\n🌇,\n🚌,ხე\n🚲,ქარი\n", encoding="utf-8")
    k = readers.emoji_keywords(spark, str(tmp_path / "e.csv"))
    e = pipeline.publish_emoji(out, {"id": "emoji", "reduce": {"umap": {"n_neighbors": 2, "seed": 1}}, "neighbors": {"k": 2}}, k, v, pipeline.reduce_vectors(vectors, s))
    assert e["count"] == 4 and e["emoji"] and ["მზე", "უცხო", "მთა"] in json.load(open(f"{out}/emoji/emoji-kw.json"))
    assert [x["id"] for x in json.load(open(f"{out}/index.json"))] == ["a", "emoji"]


def test_settings():
    corpus = {"id": "k", "extract": {"min_words": 2, "abbrev_blocklist": ["ა."], "group_by": ["strophe_id"]}, "vocab": {"min_occ": 3, "min_freq": 5, "aff": "x.aff", "lemma_sources": ["a.dic", "b.csv"], "blocklist": "b.txt", "stopwords": "s.txt"}}
    own = {"id": "d", "corpus": "k", "name_en": "D", "model": {"id": "m"}, "embed": {"N": 7, "seed": 5, "layer": "last"}, "reduce": {"umap": {"n_neighbors": 9, "metric": "cosine"}, "reference": "d", "aligned_group": "g"}}
    s = pipeline.Settings.of({k: v for k, v in corpus.items() if k != "id"}, own)
    assert (s.id, s.corpus, s.min_words, s.max_words, s.abbreviations, s.group_by, s.min_occurrences) == ("d", "k", 2, 60, ("ა.",), ("strophe_id",), 5)
    assert (s.affixes, s.lemma_sources, s.word_lists, s.contexts, s.sample_seed, s.umap) == ("x.aff", ("a.dic", "b.csv"), ("b.txt", "s.txt"), 7, 5, {"n_neighbors": 9})
    assert s.alphabet.abbreviations == ("ა.",) and s.described()["reference"] and s.described()["name_ka"] == "d" and s.described()["seeds"]["sample"] == 5
    with pytest.raises(ValueError):
        sinks.record(**s.described(), vocab_hash="h")


def test_command_line(spark, tmp_path, capsys):
    words = "მზე მთა ზღვა ტბა წიგნი სახლი ქარი ხე გზა ცხენი".split()
    pages = {f"a/p{d}.html": "<html><body>" + "".join(f"<p>{words[(d + k) % 10]} {words[(d * k) % 10]} {words[k % 10]} {words[(d + 3) % 10]}.</p>" for k in range(8)) + "</body></html>" for d in range(40)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for name, html in pages.items():
            z.writestr(name, html)
    (tmp_path / "stop.txt").write_text("გზა\n", encoding="utf-8")
    (tmp_path / "lemmas.csv").write_text("word\n" + "\n".join(words) + "\n", encoding="utf-8")
    (tmp_path / "corpus.yaml").write_text(yaml.safe_dump({"vocab": {"min_occ": 2, "stopwords": str(tmp_path / "stop.txt"), "lemma_sources": [str(tmp_path / "lemmas.csv"), str(tmp_path / "none.dic")]}}), encoding="utf-8")
    (tmp_path / "set.yaml").write_text(yaml.safe_dump({"id": "s", "corpus": "c", "reduce": {"umap": {"n_neighbors": 3, "min_dist": 0.1, "seed": 1}}, "neighbors": {"k": 3}}), encoding="utf-8")
    (tmp_path / "probes.json").write_text(json.dumps({"thresholds": {"c": {"hit_rate": 0.1}}, "c": [{"word": "მზე", "expected": [w for w in words if w != "მზე"]}]}), encoding="utf-8")
    (tmp_path / "e.csv").write_text("emoji,keywords_ka\n🐩,მზე\n🥑,ტბა\n🚌,ხე\n🚲,ქარი\n", encoding="utf-8")
    common = ["--config", str(tmp_path / "set.yaml"), "--corpus", str(tmp_path / "corpus.yaml"), "--work", str(tmp_path / "w")]
    run = lambda stage, *more: main([stage, *common, *more])
    out = ["--out", str(tmp_path / "dist")]
    assert run("evaluate", *out) == 0
    assert run("corpus", "--archive", str(tmp_path / "a.zip")) == 0
    assert spark.read.parquet(str(tmp_path / "w/sentences")).where("article is null").count() == 0
    assert run("vocab") == 0
    assert {r["word"] for r in spark.read.parquet(str(tmp_path / "w/vocab")).collect()} == set(words) - {"გზა"}
    assert run("embed", "--dimensions", "32", "--outfile", str(tmp_path / "v.npy")) == 0 == run("embed", "--dimensions", "32")
    assert readers.matrix(spark, str(tmp_path / "v.npy")).count() == 9
    assert run("reduce") == 0 == run("dist", *out)
    assert run("evaluate", *out, "--probes", str(tmp_path / "probes.json")) == 0
    (tmp_path / "bad.txt").write_text("მთა\n", encoding="utf-8")
    assert run("evaluate", *out, "--words", str(tmp_path / "bad.txt")) == 1 and "listed_word: მთა" in capsys.readouterr().out
    assert run("emoji", *out, "--csv", str(tmp_path / "e.csv"), "--name-en", "E") == 0
    assert [(e["id"], e["model"], e.get("emoji")) for e in sinks.read_json(str(tmp_path / "dist/index.json"))] == [("emoji", "E", True), ("s", "s", None)]
    (tmp_path / "v.csv").write_text("id,line,chapter,chapter_id,strophe_id,line_id\n1,აა ბბ,t,1,1,1\n2,გგ,t,1,1,2\n3,დდ,t,1,2,1\n", encoding="utf-8")
    assert run("corpus", "--verse", str(tmp_path / "v.csv")) == 0
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "w/sentences")).collect())) == [(0, "t", "აა ბბ გგ"), (1, "t", "დდ")]
    xml = "<mediawiki>" + "".join(f"<page><title>T{n}</title><ns>0</ns><id>{n}</id><revision><text>{t}</text></revision></page>" for n, t in ((1, "[[a|მზე]] მთა ზღვა ტბა."), (2, "#REDIRECT x"))) + "</mediawiki>"
    (tmp_path / "d.xml").write_text(xml, encoding="utf-8")
    assert run("corpus", "--xml", str(tmp_path / "d.xml")) == 0
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "w/sentences")).collect()] == [(0, "T1", "მზე მთა ზღვა ტბა.")]
