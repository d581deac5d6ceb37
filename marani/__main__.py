"""Stages from the command line: python -m marani STAGE ..."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import contexts, layout, morph, vocab
from .plans import pipeline
from .runtime import ship
from .sources import files, readers, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marani")
    sub = p.add_subparsers(dest="stage", required=True)
    stage = {n: sub.add_parser(n) for n in ("corpus", "vocab", "collapse", "embed", "reduce", "dist", "emoji", "evaluate")}
    for s in stage.values():
        s.add_argument("--config", help="YAML file of the dataset")
        s.add_argument("--corpus", help="YAML file of its corpus")
        s.add_argument("--work", default="work", help="folder of the tables between stages")
    source = stage["corpus"].add_mutually_exclusive_group(required=True)
    source.add_argument("--documents", help="Parquet table of doc_id, text, title")
    source.add_argument("--archive", help="ZIP archive of HTML pages")
    source.add_argument("--xml", help="XML dump of a wiki")
    source.add_argument("--verse", help="CSV file of verse lines")
    stage["corpus"].add_argument("--limit", type=int, help="first documents, pages or groups of verse")
    stage["vocab"].add_argument("--affixes", help="affix file; else that of the configuration")
    stage["vocab"].add_argument("--dictionary", help="Hunspell dictionary; else those of the configuration")
    stage["vocab"].add_argument("--lemmas", nargs="*", default=[], help="CSV files of lemmas, beside those of the configuration")
    stage["vocab"].add_argument("--words", nargs="*", default=[], help="lists of words to leave out, beside those of the configuration")
    stage["collapse"].add_argument("--target", type=int)
    stage["collapse"].add_argument("--vectors", action="store_true", help="also keep the vectors of the rows that stand")
    stage["embed"].add_argument("--limit", type=int, help="first words of the vocabulary")
    stage["embed"].add_argument("--dimensions", type=int, default=256)
    stage["embed"].add_argument("--layer-frac", type=float, help="part of the encoder's layers; the stand-in encoder has none")
    stage["embed"].add_argument("--outfile", help="Parquet table or .npy file for the vectors, in place of the work folder's")
    for n in ("reduce", "dist"):
        stage[n].add_argument("--reference", help="work folder of the dataset that this one is aligned to")
    stage["dist"].add_argument("--out", default="dist")
    stage["emoji"].add_argument("--csv", required=True)
    stage["emoji"].add_argument("--source", help="work folder of the dataset whose vectors are used; else --work")
    stage["emoji"].add_argument("--min-coverage", type=float, default=0.5)
    stage["emoji"].add_argument("--out", default="dist")
    stage["emoji"].add_argument("--id", default="emoji")
    stage["emoji"].add_argument("--name-ka", default="")
    stage["emoji"].add_argument("--name-en", default="")
    stage["evaluate"].add_argument("--out", default="dist")
    stage["evaluate"].add_argument("--probes")
    stage["evaluate"].add_argument("--words", nargs="*", default=[], help="lists of words that no label may be, beside those of the configuration")
    return p


def _there(*paths: str | None) -> list[str]:
    """The files that exist; others are named and passed over."""
    found = []
    for p in filter(None, paths):
        if files.size(p) is None:
            print(f"passed over, as it isn't there: {p}", file=sys.stderr)
        else:
            found.append(p)
    return found


def _lists(spark: SparkSession, *paths: str) -> DataFrame | None:
    found = _there(*paths)
    return readers.word_files(spark, *found) if found else None


def _forms(spark: SparkSession, s: pipeline.Settings, a: argparse.Namespace) -> DataFrame | None:
    """The map from forms to lemmas by all dictionaries and lists of lemmas; None without any."""
    sources = _there(*([a.dictionary] if a.dictionary else [x for x in s.lemma_sources if x.endswith(".dic")]))
    lists = _there(*a.lemmas, *(x for x in s.lemma_sources if not x.endswith(".dic")))
    lemmas = [readers.lemma_list(spark, x, s.alphabet) for x in lists]
    union = None
    for x in lemmas:
        union = x if union is None else union.unionByName(x)
    rules = _there(a.affixes or s.affixes)
    if not sources:
        return None if union is None else vocab.form_to_lemma(union.select(F.col("lemma").alias("form"), "lemma"))
    affixes = morph.parse_affixes(files.read(rules[0]).decode()) if rules else morph.Affixes([])
    stems = None
    for x in sources:
        own = readers.dictionary(spark, x, affixes.flag_kind)
        stems = own if stems is None else stems.unionByName(own)
    return pipeline.build_forms(stems, affixes, union, s.alphabet)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("marani").getOrCreate()
    ship(spark)
    corpus_config = readers.config(a.corpus) if a.corpus else {}
    config = readers.config(a.config) if a.config else {"id": "dataset"}
    s, w = pipeline.Settings.of({k: v for k, v in corpus_config.items() if k != "id"}, config), a.work

    def read(name: str, folder: str = w) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    def words(folder: str = w) -> DataFrame:
        # The collapsed vocabulary where there is one, else the raw one.
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/collapsed")
        return read("collapsed" if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path) else "vocab", folder)

    def laid_out(v: DataFrame) -> tuple:
        reference = tuple(read(n, a.reference) for n in ("layout_raw", "layout_points", "layout_box")) if a.reference else None
        laid = layout.aligned_layout(v, *(reference or ()), **s.umap)
        for name, table in zip(("layout_raw", "layout_points", "layout_box"), laid):
            table.write.mode("overwrite").parquet(f"{w}/{name}")
        return reference, laid

    if a.stage == "corpus":
        if a.verse:
            made = pipeline.verse_corpus(readers.verse(spark, a.verse), s, a.limit)
        elif a.archive:
            made = pipeline.build_sentences(pipeline.archive_documents(readers.pages(readers.archive(spark, a.archive)), a.limit), s, s.alphabet)
        else:
            documents = spark.read.parquet(a.documents) if a.documents else pipeline.dump_documents(readers.xml_dump(spark, a.xml))
            made = pipeline.build_sentences(documents, s, s.alphabet, a.limit)
        made.write.mode("overwrite").parquet(f"{w}/sentences")
    elif a.stage == "vocab":
        v = pipeline.build_vocabulary(read("sentences"), _forms(spark, s, a), _lists(spark, *a.words, *s.word_lists), s, s.alphabet)
        v.write.mode("overwrite").parquet(f"{w}/vocab")
        print(json.dumps({"count": read("vocab").count(), "vocab_hash": vocab.vocabulary_hash(read("vocab")).first()[0]}))
    elif a.stage == "collapse":
        vocab.collapse(read("vocab"), target=a.target).write.mode("overwrite").parquet(f"{w}/collapsed")
        if a.vectors:
            kept = read("collapsed").select("i", "src_i").join(read("vectors").withColumnRenamed("i", "src_i"), "src_i").select("i", "vec")
            kept.write.mode("overwrite").parquet(f"{w}/collapsed_vectors")
    elif a.stage == "embed":
        v = words()
        v = v if a.limit is None else v.where(F.col("i") < a.limit)
        if a.layer_frac is not None:
            print("the stand-in encoder has no layers, so --layer-frac changes nothing", file=sys.stderr)
        encoder = contexts.HashedNgrams(a.dimensions)
        make = lambda part: pipeline.build_vectors(part, read("sentences"), encoder, a.dimensions, s, s.alphabet)
        if a.outfile and a.outfile.endswith(".npy"):
            sinks.write_matrix(make(v), a.outfile)
        elif a.outfile:
            make(v).write.mode("overwrite").parquet(a.outfile)
        else:
            sinks.resumable(v, f"{w}/vector_parts", "i", make).write.mode("overwrite").parquet(f"{w}/vectors")
    elif a.stage == "reduce":
        pipeline.reduce_vectors(read("vectors"), s).write.mode("overwrite").parquet(f"{w}/reduced")
        _, laid = laid_out(read("vectors"))
        if laid[3] is not None:
            print(json.dumps(laid[3].first().asDict()))
    elif a.stage == "dist":
        reference, laid = laid_out(read("vectors"))
        print(json.dumps(pipeline.publish(a.out, config, words(), read("vectors"), reference, laid), ensure_ascii=False))
    elif a.stage == "emoji":
        source = a.source or w
        names = {k: v for k, v in (("name_ka", a.name_ka), ("name_en", a.name_en)) if v}
        own = config | {"id": a.id, "reduce": {**config.get("reduce", {}), "dim128_method": "mrl"}} | names
        meta = pipeline.publish_emoji(a.out, own, readers.emoji_keywords(spark, a.csv), words(source), pipeline.reduce_vectors(read("vectors", source), s), a.min_coverage)
        print(json.dumps(meta, ensure_ascii=False))
    else:
        if files.size(f"{a.out}/index.json") is None:
            print("nothing is published yet")
            return 0
        records = [sinks.read_json(f"{a.out}/{e['id']}/meta.json") for e in sinks.read_json(f"{a.out}/index.json")]
        names = {r["corpus"] for r in records if r.get("corpus")}
        probes = {n: readers.probes(spark, a.probes, n) for n in names} if a.probes else {}
        least = readers.probe_thresholds(spark, a.probes) if a.probes else {}
        failures = pipeline.evaluate(spark, a.out, records, probes, _lists(spark, *a.words, *s.word_lists), least).collect()
        for r in failures:
            print(f"{r['check']}: {r['detail']}")
        return int(bool(failures))
    return 0


if __name__ == "__main__":
    sys.exit(main())
