from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from marani.functions import vectors as V
from marani.operators import neighbours
from marani.sources import binary, readers, sinks


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_text_readers(spark, tmp_path):
    p = put(tmp_path / "s.jsonl", '{"id": 1, "article": "ა", "text": "ტ"}\n\n{broken\n{"id": 2, "text": null}\n')
    assert {r["id"] for r in readers.jsonl(spark, p, readers.SENTENCES).collect()} == {1, 2}
    p = put(tmp_path / "v.jsonl", '{"i": 0, "word": "ა", "lemma": "ა", "freq": 3, "occ": [[5, "ა"], [6, "აბ"]]}\n')
    assert [(o["sid"], o["form"]) for o in readers.vocabulary(spark, p).first()["occ"]] == [(5, "ა"), (6, "აბ")]
    p = put(tmp_path / "w.txt", "# list\nᲓᲐ\n\n რომ # so\nდა\n")
    assert {r[0] for r in readers.word_files(spark, p).collect()} == {"და", "რომ"}
    p = put(tmp_path / "l.csv", "word,x\nმზე,1\nა,2\nabc,3\nცა,4\n")
    assert {r[0] for r in readers.lemma_list(spark, p).collect()} == {"მზე", "ცა"}
    p = put(tmp_path / "d.dic", "3\nკატა/NSVC\nსახლი\n")
    assert {(r[0], tuple(r[1])) for r in readers.dictionary(spark, p).collect()} == {("კატა", ("NS", "VC")), ("სახლი", ())}
    p = put(tmp_path / "labels.tsv", 'ა\t5\nბ"\t\nგ\n')
    assert [tuple(r) for r in readers.labels(spark, p).collect()] == [(0, "ა", 5), (1, 'ბ"', 0), (2, "გ", 0)]
    p = put(tmp_path / "verse.csv", "id,line,chapter,chapter_id,strophe_id,line_id\n1,ა,ბ,1,1,1\n")
    assert readers.verse(spark, p).first()["id"] == 1
    p = put(tmp_path / "f.csv", "a,b\nx,\n")
    assert readers.filled_csv(spark, p, "a string, b string").first()["b"] == ""
    p = put(tmp_path / "e.csv", "emoji,keywords_ka\n🐩,ა| ბ ||გ\n")
    assert [(r["rank"], r["keyword"]) for r in readers.emoji_keywords(spark, p).collect()] == [(0, "ა"), (1, "ბ"), (2, "გ")]
    p = put(tmp_path / "a.json", '["ა ბ გ დ", "x y"]')
    assert [tuple(r) for r in readers.analogies(spark, p).collect()] == [("ა", "ბ", "გ", "დ")]
    p = put(tmp_path / "r.json", '{"s": ["t", "u"]}')
    assert {tuple(r) for r in readers.related_terms(spark, p).collect()} == {("s", "t"), ("s", "u")}
    p = put(tmp_path / "p.json", '{"v": 1, "c": [{"word": "ა", "expected": ["ბ"]}]}')
    assert tuple(readers.probes(spark, p, "c").first()) == ("ა", ["ბ"], [])
    p = put(tmp_path / "t.txt", "ერთი. ორი.\nსამი.")
    assert readers.whole_text(spark, p).first()["sentences"] == ["ერთი.", "ორი.", "სამი."]
    p = put(tmp_path / "c.yaml", "id: x\n")
    assert readers.config(p) == {"id": "x", "_config_path": p} == readers.config("c", str(tmp_path))


def test_pages(spark, tmp_path):
    entries = [("a", "A", "text/html", False, "ა".encode() + b"\xff"), ("b", "B", "text/html", True, b"x"), ("c", "C", "image/png", False, b"x"), ("d", "D", "text/html", None, None)]
    df = spark.createDataFrame(entries, "path string, title string, mimetype string, redirect boolean, content binary")
    assert [(r["page_id"], r["html"]) for r in readers.pages(df).collect()] == [("a", "ა")]
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/Page.html", "<body><p>ა</p></body>")
        z.writestr("x/pic.png", b"1")
    assert [(r["page_id"], r["title"]) for r in readers.pages(readers.archive(spark, str(tmp_path / "a.zip"))).collect()] == [("x/Page.html", "Page")]
    xml = "<mediawiki><page><title>T</title><ns>0</ns><id>7</id><revision><timestamp>t</timestamp><contributor><ip>1.2</ip></contributor><text bytes='3'>#REDIRECT x</text><sha1>s</sha1></revision></page><page><title>U</title><ns>1</ns><id>8</id></page></mediawiki>"
    got = readers.xml_dump(spark, put(tmp_path / "d.xml", xml)).collect()
    assert [(r["id"], r["author"], r["is_redirect"]) for r in got] == [("7", "1.2", True)]


def test_dataset_round_trip(spark, tmp_path):
    m = np.random.default_rng(1).normal(size=(40, 16)).astype("f4")
    v = spark.createDataFrame([(n, [float(x) for x in r]) for n, r in enumerate(m)], "i long, vec array<double>").repartition(3)
    vocab = v.select("i", F.concat(F.lit("w"), "i").alias("word"), (F.col("i") * 2).alias("freq"))
    points = v.select("i", F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y"))
    near = neighbours.exact_neighbours(v, 5)
    q = v.select("i", V.quantize_i8(F.col("vec")).alias("quantized"))
    meta = dict.fromkeys(sinks.RECORD) | {"id": "d", "name_en": "D", "count": 40, "dims_full": 16, "dims_i8": 16}
    meta = sinks.record(**meta)
    folder = str(tmp_path / "dist")
    for _ in range(2):
        sizes = sinks.write_dataset(folder, meta, vocab, points, near, q)
    assert sizes == {"labels.tsv": os.path.getsize(f"{folder}/d/labels.tsv"), "points.f32": 320, "neighbors.bin": 600, "vectors.i8": 640, "vscales.f32": 160}
    assert len(json.load(open(f"{folder}/index.json"))) == 1
    assert [r["word"] for r in readers.labels(spark, f"{folder}/d/labels.tsv").collect()] == [f"w{n}" for n in range(40)]
    back = binary.read_packed(spark, f"{folder}/d/neighbors.bin", "neighbors", 40).orderBy("i").collect()
    want = {r["i"]: r["l"] for r in near.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("rank", "j", "sim_u8"))).alias("l")).collect()}
    assert all([(x["j"], x["sim_u8"]) for x in want[r["i"]]] == list(zip(r["idx"], r["sim"])) for r in back)
    p = binary.read_packed(spark, f"{folder}/d/points.f32", "points", 40).orderBy("i").collect()
    assert np.allclose([(r["x"], r["y"]) for r in p], m[:, :2])
    z = binary.read_packed(spark, f"{folder}/d/vectors.i8", "vectors", 40, 16).orderBy("i").collect()
    s = binary.read_packed(spark, f"{folder}/d/vscales.f32", "vscales", 40).orderBy("i").collect()
    assert np.abs(np.array([r["q"] for r in z]) * np.array([[r["scale"]] for r in s]) - m).max() < 0.03
    assert binary.read_packed(spark, f"{folder}/d/neighbors.bin", "neighbors", 41).count() == 0
    files = {r["name"]: r["length"] for r in sinks.files_table(spark, folder).collect()}
    assert files["points.f32"] == 320 and "index.json" in files


def test_wide_neighbours(spark, tmp_path):
    near = spark.createDataFrame([(0, 0, 65_536, 255), (0, 1, -1, 0), (1, 0, 2**31 - 1, 7), (1, 1, 0, 200)], "i int, rank int, j long, sim_u8 int")
    assert neighbours.index_bytes(near) == 4
    assert [neighbours.index_bytes(near.where(c)) for c in ("j = 0", "false", "j = 65536", "j < 0")] == [2, 2, 4, 4]
    path = str(tmp_path / "neighbors.bin")
    assert sinks.write_neighbours(near, path, 4) == 20
    assert open(path, "rb").read() == bytes([0, 0, 1, 0, 255, 255, 255, 255, 255, 0, 255, 255, 255, 127, 7, 0, 0, 0, 0, 200])
    back = binary.read_packed(spark, path, "neighbors", 2, index_bytes=4).orderBy("i").collect()
    assert [tuple(r) for r in back] == [(0, [65_536, -1], [255, 0]), (1, [2**31 - 1, 0], [7, 200])]
    with pytest.raises(Exception, match="32 bits"):
        sinks.write_neighbours(near.withColumn("j", F.lit(2**31)), path, 4)


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(0, "Ab", 3, [1.0, 2.0]), (1, "c", 1, [0.5, 0.25])], "i int, word string, count int, vec array<double>")
    assert sinks.write_jsonl(df, str(tmp_path / "j")) == 2
    head = sinks.write_projector(df, str(tmp_path / "p"), "n")
    assert head["embeddings"][0]["tensorShape"] == [2, 2]
    assert (tmp_path / "p/n_tensors.tsv").read_text() == "1.00000000\t2.00000000\n0.50000000\t0.25000000"
    assert (tmp_path / "p/n_labels.tsv").read_text() == "word\tcount\nab\t3\nc\t1\n"
    with pytest.raises(ValueError):
        sinks.write_projector(df.withColumn("word", F.lit("a\tb")), str(tmp_path / "q"), "n")
    sinks.write_word2vec_text(df, str(tmp_path / "w2v.txt"))
    assert (tmp_path / "w2v.txt").read_text().splitlines()[0] == "2 2"
    a = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    got = sinks.catalog_upsert(a, spark.createDataFrame([("b", 9), ("c", 3)], "id string, n int")).collect()
    assert [tuple(r) for r in got] == [("a", 1), ("b", 9), ("c", 3)]
    assert sinks.config_hash({"b": 1, "a": 2, "_p": 3}) == sinks.config_hash({"a": 2, "b": 1})
    calls = []

    def make(part):
        calls.append(1)
        return part.select("i", (F.col("i") * 10).alias("x"))

    for _ in range(2):
        out = sinks.resumable(df, str(tmp_path / "r"), "i", make, 3)
    assert sorted(r["x"] for r in out.collect()) == [0, 10] and len(calls) == 3 + 2  # each part once, the schema twice
    np.save(tmp_path / "m.npy", np.arange(6, dtype="f4").reshape(3, 2))
    assert [r["vec"] for r in readers.matrix(spark, str(tmp_path / "m.npy")).collect()] == [[0, 1], [2, 3], [4, 5]]
    np.savez(tmp_path / "m.npz", a=np.ones((2, 2), "f4"))
    assert readers.matrix(spark, str(tmp_path / "m.npz"), "a").count() == 2
