"""Registered queries of sources, sinks, checks and small operators: most write a table out, read it back and give what was read."""

from __future__ import annotations

import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.alphabet import SPACE
from ..operators import contexts, corpus, evaluation, layout, lookup, morph, neighbours, quality, vocab
from ..runtime import own_dir
from ..sources import binary, files, readers, sinks
from .queries import _L, _P, _QUANT, _UNIT, _WINDOW, SMALL_AFFIXES, _digits, _points, _sql_stem, _table, _vectors, _window_rows, query


def _trim(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def _at(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _numbered(df: DataFrame, order: str = "i") -> DataFrame:
    return corpus.dense_ids(df, [order], "at", "numbered").drop(order).withColumnRenamed("at", order)


# ---------------------------------------------------------------- tables and texts


@query("SELECT id, article, text FROM sentences")
def jsonl_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "jsonl")
    sinks.write_jsonl(_table(spark, folder, "sentences").select("id", "article", "text"), at)
    return readers.jsonl(spark, at, readers.SENTENCES)


@query("SELECT i, coalesce(word, '') AS word, coalesce(lemma, '') AS lemma FROM vocab")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "csv")
    sinks.write_csv(_table(spark, folder, "vocab").select("i", "word", "lemma"), at)
    return readers.filled_csv(spark, at, "i int, word string, lemma string")


@query("SELECT 'სიტყვა ' || id || '.' AS sentence FROM sentences")
def whole_text_sentences(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "lines")
    sinks.write_lines(_table(spark, folder, "sentences").select(F.concat(F.lit("სიტყვა "), "id", F.lit(".")).alias("line")), "line", at)
    return readers.whole_text(spark, at).select(F.explode("sentences").alias("sentence"))


@query("SELECT i AS id, coalesce(nullif(word, ''), '-') AS line, coalesce(nullif(lemma, ''), '-') AS chapter FROM vocab")
def verse_file(spark: SparkSession, folder: str) -> DataFrame:
    at, filled = _at(spark, "verse"), lambda c: F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit("-"))
    v = _table(spark, folder, "vocab")
    sinks.write_csv(v.select(F.col("i").alias("id"), filled("word").alias("line"), filled("lemma").alias("chapter"), F.lit("1").alias("chapter_id"), F.lit("1").alias("strophe_id"), F.lit("1").alias("line_id")), at)
    return readers.verse(spark, at).select("id", "line", "chapter")


@query("SELECT subject || '.html' AS page_id, subject AS title, unnest(terms_ka) AS text, unnest(range(len(terms_ka)))::int AS para_ix FROM subjects")
def archive_pages(spark: SparkSession, folder: str) -> DataFrame:
    """An archive of pages, one for each of the few subjects, read to paragraphs."""
    rows = _table(spark, folder, "subjects").collect()
    with tempfile.TemporaryDirectory() as own:  # the archive is put together by the driver and then written to the shared folder
        with zipfile.ZipFile(f"{own}/a.zip", "w") as z:
            for r in rows:
                z.writestr(f"{r['subject']}.html", "<html><body><table><tr><td><p>x</p></td></tr></table>" + "".join(f"<p>{t} <sup>1</sup></p>" for t in r["terms_ka"]) + "</body></html>")
            z.writestr("style.css", "p {}")
        with open(f"{own}/a.zip", "rb") as f:
            at = f"{_at(spark, 'archive')}/a.zip"
            files.write(at, [f.read()])
    pages = readers.pages(readers.archive(spark, at))
    return corpus.page_paragraphs(pages).join(pages.select("page_id", "title"), "page_id").select("page_id", "title", "text", "para_ix")


@query(f"SELECT doc_id::varchar AS id, {_trim('title')} AS title, lang AS author, starts_with(title, '#REDIRECT') AS is_redirect FROM documents WHERE {_trim('title')} <> ''")
def xml_pages(spark: SparkSession, folder: str) -> DataFrame:
    at, title = _at(spark, "xml"), X.strip(F.col("title"))
    d = _table(spark, folder, "documents").where(title != "")
    revision = F.struct(F.lit("t").alias("timestamp"), F.struct(F.col("lang").alias("username")).alias("contributor"), F.struct(title.alias("_VALUE"), F.lit("x").alias("_space")).alias("text"), F.lit("s").alias("sha1"))
    d.select(F.col("doc_id").alias("id"), F.lit("0").alias("ns"), title.alias("title"), revision.alias("revision")).write.format("xml").option("rowTag", "page").option("rootTag", "mediawiki").save(at)
    return readers.xml_dump(spark, at).select("id", "title", "author", "is_redirect")


_LINES = f"SELECT doc_id, {_trim('line')} AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL) WHERE {_trim('line')} <> ''"


@query(_LINES)
def html_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Pages made of whole documents, a paragraph for each line, beside parts that aren't running text."""
    d = _table(spark, folder, "documents").where("text IS NOT NULL")
    escaped = F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><body><div class='infobox'><p>x</p></div><p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")), F.lit("<sup>2</sup></p></body></html>"))
    return corpus.page_paragraphs(d.select("doc_id", page.alias("html")), "doc_id").select("doc_id", "text")


def _sql_markup() -> str:
    t = "text"
    for pattern, to in (
        [(r"(?s)<!--.*?-->|<ref[^>/]*/>|<ref[^>]*>.*?</ref>|<math[^>]*>.*?</math>|<nowiki[^>]*>.*?</nowiki>|<gallery[^>]*>.*?</gallery>", "")]
        + [(r"(?s)\{\{[^{}]*\}\}", "")] * 4 + [(r"(?s)\{\|.*?\|\}", "")]
        + [(r"\[\[(?:[^\[\]:|]+):[^\[\]]*\]\]", ""), (r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1")] * 3
        + [(r"\[(?:https?|ftp)://[^\s\]]+\s*([^\]]*)\]", r"\1"), (r"</?[a-zA-Z][^<>]*>|'{2,}", ""), (r"(?m)^=+\s*(.*?)\s*=+\s*$", r"\1")]
    ):
        t = f"regexp_replace({t}, '{pattern.replace(chr(39), chr(39) * 2)}', '{to}', 'g')"
    return t


@query(f"SELECT doc_id, {_sql_markup()} AS text FROM documents")
def markup_in_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", X.remove_markup(F.col("text")).alias("text"))


@query("SELECT DISTINCT lower(unnest(terms_ka)) AS word FROM subjects")
def word_lists(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "words")
    terms = _table(spark, folder, "subjects").select(F.explode("terms_ka").alias("w"))
    sinks.write_lines(terms.select(F.concat("w", F.lit("  # a comment")).alias("w")).unionByName(terms).unionByName(terms.select(F.lit("# only a comment").alias("w"))), "w", at)
    return readers.word_files(spark, at)


@query(f"SELECT DISTINCT lower(trim(lemma)) AS lemma FROM vocab WHERE regexp_full_match(lower(trim(lemma)), '[{_L}]+') AND length(trim(lemma)) >= 2")
def lemma_lists(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "lemmas")
    sinks.write_csv(_table(spark, folder, "vocab").select(F.col("lemma").alias("word"), "i"), at)
    return readers.lemma_list(spark, at)


@query(f"SELECT DISTINCT lemma AS stem, unnest(['NA', 'VC']) AS flag FROM vocab WHERE regexp_full_match(lemma, '[{_L}]+')")
def dictionary_stems(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "dictionary")
    good = _table(spark, folder, "vocab").where(X.is_word(F.col("lemma"))).select("lemma").distinct()
    sinks.write_lines(good.select(F.concat("lemma", F.lit("/NAVC po:noun")).alias("line")).unionByName(spark.createDataFrame([("12345",)], "line string")), "line", at)
    return readers.dictionary(spark, at).select("stem", F.explode("flags").alias("flag"))


@query(
    """SELECT * FROM (VALUES ('SFX', 'NA', '', 'ს', '[აეიოუ]', 0), ('SFX', 'NA', 'ი', 'ის', 'ი', 0), ('SFX', 'NB', '', 'ში', '.', 0),
    ('SFX', 'VC', 'ი', 'ეთ', 'ი', 2), ('PFX', 'pA', '', 'სა', '.', 1), ('PFX', 'pB', '', 'უ', '.', 0)) t(kind, flag, strip, add, cond, flags)"""
)
def affix_rules(spark: SparkSession, folder: str) -> DataFrame:
    return morph.rules_table(spark, morph.parse_affixes(SMALL_AFFIXES)).select("kind", "flag", "strip", "add", "cond", F.size("add_flags").alias("flags"))


@query(
    f"""WITH s AS (SELECT DISTINCT lemma AS s FROM vocab WHERE lemma IS NOT NULL AND lemma <> ''),
    x AS (SELECT s, s AS f, true AS whole FROM s UNION ALL SELECT s, s || 'ს', true FROM s WHERE regexp_matches(s, '[აეიოუ]$')
      UNION ALL SELECT s, left(s, length(s) - 1) || 'ის', true FROM s WHERE s LIKE '_%ი' UNION ALL SELECT s, s || 'ში', true FROM s
      UNION ALL SELECT s, 'სა' || left(s, length(s) - 1) || 'ეთ', false FROM s WHERE s LIKE '_%ი'),
    p AS (SELECT lower(f) AS form, lower(s) AS lemma FROM (SELECT s, f FROM x UNION ALL SELECT s, 'უ' || f FROM x WHERE whole)
      WHERE regexp_full_match(lower(f), '[{_L}]{{2,}}') AND regexp_full_match(lower(s), '[{_L}]{{2,}}'))
    SELECT form, min(lemma) AS lemma FROM p GROUP BY form HAVING count(DISTINCT lemma) = 1"""
)
def affix_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Suffixes, prefixes, both together, and a suffix that needs its prefix."""
    flags = F.array(F.lit("NA"), F.lit("NB"), F.lit("VC"), F.lit("pB"))
    stems = _table(spark, folder, "vocab").where("lemma IS NOT NULL").select(F.col("lemma").alias("stem"), flags.alias("flags")).distinct()
    return vocab.form_to_lemma(morph.form_lemma_pairs(morph.expand(stems, morph.parse_affixes(SMALL_AFFIXES))))


@query("SELECT subject, unnest(terms_ka) AS term FROM subjects")
def related_terms_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'related')}/terms.json"
    sinks.write_json(at, {r["subject"]: r["terms_ka"] for r in _table(spark, folder, "subjects").collect()})  # of the few subjects
    return readers.related_terms(spark, at)


@query("SELECT terms_ka[1] AS a, terms_ka[2] AS b, terms_ka[3] AS c, terms_ka[4] AS d FROM subjects WHERE len(terms_ka) >= 4 AND NOT contains(terms_ka[1] || terms_ka[2] || terms_ka[3] || terms_ka[4], ' ')")
def analogies_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'analogies')}/questions.json"
    sinks.write_json(at, [" ".join(r["terms_ka"][:4]) for r in _table(spark, folder, "subjects").collect()] + ["three words only"])
    return readers.analogies(spark, at)


@query("SELECT terms_ka[1] AS word, unnest(terms_ka) AS expected, subject AS forbidden FROM subjects")
def probe_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'probes')}/probes.json"
    sinks.write_json(at, {"thresholds": {"c": {"hit_rate": 0.5}}, "c": [{"word": r["terms_ka"][0], "expected": r["terms_ka"], "forbidden": [r["subject"]]} for r in _table(spark, folder, "subjects").collect()]})
    return readers.probes(spark, at, "c").select("word", F.explode("expected").alias("expected"), F.col("forbidden")[0].alias("forbidden"))


# ---------------------------------------------------------------- files of a dataset


@query("SELECT row_number() OVER (ORDER BY i) - 1 AS i, coalesce(word, '?') AS word, coalesce(freq, 0) AS freq FROM vocab")
def label_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'labels')}/labels.tsv"
    sinks.write_labels(_table(spark, folder, "vocab").select("i", F.coalesce("word", F.lit("?")).alias("word"), "freq"), at)
    return readers.labels(spark, at)


@query(
    _P.rstrip() + ", " + _UNIT.strip().removeprefix("WITH ") + _QUANT
    + "SELECT row_number() OVER (ORDER BY a.i) - 1 AS i, round(x::float::double, 6) + 0.0 AS x, round(y::float::double, 6) + 0.0 AS y, round(scale::float::double, 7) AS scale, list_sum(q)::bigint AS q FROM a JOIN q ON a.i = q.vec_id"
)
def packed_files(spark: SparkSession, folder: str) -> DataFrame:
    at, v = _at(spark, "packed"), _vectors(spark, folder)
    count, width = v.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    sinks.write_points(_points(spark, folder, 0), f"{at}/points.f32")
    sinks.write_vectors(v.select("i", V.quantize_i8(F.col("vec")).alias("quantized")), f"{at}/vectors.i8", f"{at}/vscales.f32")
    points, vectors, scales = (binary.read_packed(spark, f"{at}/{f}", k, count, width) for f, k in (("points.f32", "points"), ("vectors.i8", "vectors"), ("vscales.f32", "vscales")))
    total = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x)
    joined = points.join(vectors, "i").join(scales, "i")
    return joined.select("i", (F.round(F.col("x").cast("double"), 6) + 0.0).alias("x"), (F.round(F.col("y").cast("double"), 6) + 0.0).alias("y"), F.round(F.col("scale").cast("double"), 7).alias("scale"), total.alias("q"))


@query(
    """WITH b AS (SELECT i, min(nidx) AS nidx, min(nsim) AS nsim FROM layout WHERE len(nidx) = 15 AND len(nsim) = 15 GROUP BY i),
    n AS (SELECT row_number() OVER (ORDER BY i) - 1 AS i, nidx, nsim FROM b) SELECT i, unnest(nidx) AS j, unnest(nsim) AS sim, unnest(range(15))::int AS rank FROM n"""
)
def neighbour_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'neighbours')}/neighbors.bin"
    rows = _table(spark, folder, "layout").where("size(nidx) = 15 AND size(nsim) = 15").groupBy("i").agg(F.min("nidx").alias("nidx"), F.min("nsim").alias("nsim"))
    rows = _numbered(rows)
    each = rows.select("i", F.posexplode(F.arrays_zip("nidx", "nsim")).alias("rank", "z")).select("i", "rank", F.col("z.nidx").alias("j"), F.col("z.nsim").alias("sim_u8"))
    wide = neighbours.index_bytes(each)
    sinks.write_neighbours(each, at, wide)
    back = binary.read_packed(spark, at, "neighbors", rows.count(), index_bytes=wide)
    return back.select("i", F.posexplode(F.arrays_zip("idx", "sim")).alias("rank", "z")).select("i", F.col("z.idx").alias("j"), F.col("z.sim").cast("int").alias("sim"), "rank")


@query("SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, round(list_sum(list_transform(embedding, lambda x: x::double)), 6) + 0.0 AS total, len(embedding) AS width FROM embeddings")
def matrix_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'matrix')}/vectors.npy"
    sinks.write_matrix(_vectors(spark, folder), at)
    total = F.aggregate(F.transform("vec", lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return readers.matrix(spark, at).select("i", (F.round(total, 6) + 0.0).alias("total"), F.size("vec").alias("width"))


@query("SELECT vec_id::varchar AS word, len(embedding) AS width, round(embedding[1]::double, 6) + 0.0 AS first FROM embeddings")
def word2vec_file(spark: SparkSession, folder: str) -> DataFrame:
    at = f"{_at(spark, 'word2vec')}/vectors.txt"
    sinks.write_word2vec_text(_vectors(spark, folder).select(F.col("i").cast("string").alias("word"), "vec"), at)
    parts = F.split("value", " ")
    lines = spark.read.text(at).where(F.size(parts) > 2)
    return lines.select(parts[0].alias("word"), (F.size(parts) - 1).alias("width"), (F.round(parts[1].cast("double"), 6) + 0.0).alias("first"))


@query("SELECT 'w' || vec_id AS word, label::varchar AS count FROM embeddings")
def projector_labels(spark: SparkSession, folder: str) -> DataFrame:
    at = _at(spark, "projector")
    v = _vectors(spark, folder)
    sinks.write_projector(v.select("i", F.concat(F.lit("W"), "i").alias("word"), F.col("label").alias("count"), "vec"), at, "n")
    return spark.read.option("header", True).option("sep", "\t").csv(f"{at}/n_labels.tsv").select("word", "count")


@query("SELECT i, coalesce(freq, 0) * 10 AS x FROM vocab")
def resumed_rows(spark: SparkSession, folder: str) -> DataFrame:
    at, v = _at(spark, "resumed"), _table(spark, folder, "vocab")
    make = lambda part: part.select("i", (F.coalesce("freq", F.lit(0)) * 10).alias("x"))
    sinks.resumable(v, at, "i", make, 4)
    return sinks.resumable(v, at, "i", make, 4)


_COUNTS = "SELECT lower(trim(subject)) AS id, count(*) AS n FROM subject_labels WHERE subject IS NOT NULL GROUP BY 1"


@query(f"WITH e AS ({_COUNTS}), c AS (SELECT subject AS id, 0 AS n FROM subjects UNION ALL SELECT 'kept', 1) SELECT * FROM e UNION ALL SELECT * FROM c WHERE id NOT IN (SELECT id FROM e)")
def catalog_entries(spark: SparkSession, folder: str) -> DataFrame:
    catalog = _table(spark, folder, "subjects").select(F.col("subject").alias("id"), F.lit(0).cast("long").alias("n")).unionByName(spark.createDataFrame([("kept", 1)], "id string, n long"))
    entries = _table(spark, folder, "subject_labels").where("subject IS NOT NULL").groupBy(F.lower(F.trim("subject")).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return sinks.catalog_upsert(catalog, entries)


# ---------------------------------------------------------------- checks


_SIZES = "SELECT coalesce(lang, '?') AS name, count(*) AS length FROM documents GROUP BY 1"


@query(
    f"""WITH f AS ({_SIZES}), d AS (SELECT label AS l, min(embedding[1])::double AS median FROM embeddings GROUP BY label),
    m AS (SELECT count(*) AS present, count_if(lang = 'ka') AS hits FROM documents)
    SELECT 'label_count' AS "check", (SELECT count(*) FROM documents)::varchar AS detail WHERE (SELECT count(*) FROM documents) <> 5
    UNION ALL SELECT 'file_size', name FROM (VALUES ('ka', 5), ('en', 7), ('none', 3)) w(name, want) LEFT JOIN f USING (name) WHERE length IS DISTINCT FROM want
    UNION ALL SELECT 'total_size', sum(length)::varchar FROM f HAVING sum(length) > 100
    UNION ALL SELECT 'displacement', 'd' || l FROM d WHERE l % 4 <> 0 AND l % 3 <> 0 AND (median >= 0.35 - 0.5 OR median IS NULL)
    UNION ALL SELECT 'vocab_hash', g FROM (SELECT 'g' || (l % 4) AS g, count(DISTINCT l % 8) AS n FROM d WHERE l % 4 <> 0 GROUP BY 1) WHERE n > 1
    UNION ALL SELECT 'probes', round(hits / present, 6)::varchar FROM m WHERE present > 0 AND hits / present < 0.99
    UNION ALL SELECT 'coverage', 'low' WHERE true"""
)
def gate_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of counts, sizes, displacements, hashes and rates that these tables break."""
    d = _table(spark, folder, "documents")
    f = d.groupBy(F.coalesce("lang", F.lit("?")).alias("name")).agg(F.count(F.lit(1)).alias("length"))
    each = _table(spark, folder, "embeddings").groupBy("label").agg(F.min(F.col("embedding")[0].cast("double")).alias("median"))
    group = F.when(F.col("label") % 4 != 0, F.concat(F.lit("g"), (F.col("label") % 4).cast("string")))
    sets = each.select(F.concat(F.lit("d"), F.col("label").cast("string")).alias("id"), group.alias("aligned_group"), (F.col("label") % 3 == 0).alias("reference"), "median", (F.col("label") % 8).alias("vocab_hash"))
    metrics = d.agg(F.count(F.lit(1)).alias("present"), F.count_if(F.col("lang") == "ka").alias("hits"), F.lit(0).alias("forbidden"))
    metrics = metrics.withColumn("hit_rate", F.round(F.col("hits") / F.col("present"), 6))
    coverage = spark.createDataFrame([("low", False), ("high", True)], "part string, enough boolean")
    return quality.gate(
        quality.count_is(d, 5), quality.file_sizes(f, {"ka": 5, "en": 7, "none": 3}), quality.total_size(f, 100), quality.displacement_below(sets, 0.35 - 0.5),
        quality.one_hash_per_group(sets), quality.probes_pass(metrics, 0.99), quality.covered(coverage),
    )


@query(
    f"""WITH v AS (SELECT i, {_sql_stem("word")} AS root FROM vocab WHERE word IS NOT NULL), f AS (SELECT root, min(i) AS i FROM v GROUP BY root),
    n AS (SELECT f.root, v.root AS near FROM layout l JOIN f ON f.i = l.i, unnest(l.nidx) t(j) JOIN v ON v.i = j)
    SELECT count(*) AS probes, count(*) AS present, count(*) AS forbidden FROM (SELECT DISTINCT root FROM n)"""
)
def forbidden_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Probes of which every neighbour is forbidden, so each breaks its check."""
    v, near = _table(spark, folder, "vocab").where("word IS NOT NULL"), _table(spark, folder, "layout").select("i", F.explode("nidx").alias("j")).distinct()
    roots = v.select("i", "word", X.stem(F.col("word")).alias("root"))
    first = roots.groupBy("root").agg(F.min(F.struct("i", "word")).alias("f")).select("f.i", "f.word")
    pairs = near.join(first, "i").join(v.select(F.col("i").alias("j"), F.col("word").alias("other")), "j")
    probes = pairs.groupBy("word").agg(F.collect_set("other").alias("forbidden")).withColumn("expected", F.array().cast("array<string>"))
    return evaluation.probe_metrics(probes, v, near).select("probes", "present", "forbidden")


@query("WITH b AS (SELECT i, min(nidx) AS nidx FROM layout WHERE nidx IS NOT NULL GROUP BY i), r AS (SELECT i, unnest(nidx) AS j, unnest(range(len(nidx))) AS rank FROM b) SELECT rank, j, word FROM r JOIN vocab ON vocab.i = j WHERE r.i = (SELECT min(i) FROM b)")
def related_words_of_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "layout").where("nidx IS NOT NULL").groupBy("i").agg(F.min("nidx").alias("nidx"))
    near = rows.select("i", F.posexplode("nidx").alias("rank", "j")).withColumn("sim_u8", F.lit(0))
    return lookup.related_words(near, _table(spark, folder, "vocab"), rows.agg(F.min("i")).first()[0]).select("rank", "j", "word")


@query("SELECT doc_id, source || ':' || title AS title FROM documents WHERE source || ':' || title NOT LIKE 'wikidump-main:%' ORDER BY md5('1|' || doc_id), doc_id LIMIT 100")
def colon_sources(spark: SparkSession, folder: str) -> DataFrame:
    d = _table(spark, folder, "documents").select("doc_id", F.concat("source", F.lit(":"), "title").alias("title"))
    return corpus.random_rows(corpus.other_namespaces(d, known=("wikidump-main:",)), 100, "doc_id").select("doc_id", "title")


@query("SELECT doc_id, n_chars FROM documents ORDER BY coalesce(n_chars, 0) DESC, doc_id LIMIT 200")
def best_documents(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.best_trials(_table(spark, folder, "documents").select("doc_id", "n_chars"), "n_chars")


# ---------------------------------------------------------------- vectors of contexts


@query(
    f"""WITH w AS (SELECT form, length(text)::double AS a, start::double AS b, "end"::double AS c FROM ({_WINDOW})),
    m AS (SELECT form, avg(a) AS a, avg(b) AS b, avg(c) AS c, count(*) AS n_used FROM w GROUP BY form)
    SELECT form, n_used, round(a / sqrt(a * a + b * b + c * c + 1), 6) + 0.0 AS x, round(b / sqrt(a * a + b * b + c * c + 1), 6) + 0.0 AS y, round(c / sqrt(a * a + b * b + c * c + 1), 6) + 0.0 AS z FROM m"""
)
def context_means(spark: SparkSession, folder: str) -> DataFrame:
    """The pooling of contexts, with an encoder that SQL can follow: the length of the text and where the word stands."""

    def encoder(texts: list[str], spans: list[tuple[int, int]]) -> np.ndarray:
        return np.array([[len(t), a, b, 1] for t, (a, b) in zip(texts, spans)], float)

    made = contexts.embed(_window_rows(spark, folder), encoder, 4, "form")
    return made.select("form", "n_used", *((F.round(F.col("vec")[n], 6) + 0.0).alias(c) for n, c in enumerate("xyz")))


@query(
    """WITH t AS (SELECT label AS i, vec_id // 5 AS row, embedding[1]::double AS x, embedding[2]::double AS y, vec_id % 5 AS place, vec_id % 5 + vec_id % 3 AS until FROM embeddings),
    c AS (SELECT i, row, avg(x) AS x, avg(y) AS y FROM t WHERE until > place AND place < 4 AND until > 1 GROUP BY i, row),
    m AS (SELECT i, avg(x) AS x, avg(y) AS y, count(*) AS n_used FROM c GROUP BY i)
    SELECT i, n_used, round(x / sqrt(x * x + y * y), 6) + 0.0 AS x, round(y / sqrt(x * x + y * y), 6) + 0.0 AS y FROM m"""
)
def span_means(spark: SparkSession, folder: str) -> DataFrame:
    """The pooling of tokens, taking vectors as tokens that lie beside each other."""
    e = _table(spark, folder, "embeddings")
    at = F.col("vec_id") % 5
    tokens = e.select(F.col("label").alias("i"), F.expr("vec_id div 5").alias("row"), F.slice("embedding", 1, 2).alias("vec"), at.alias("at"), (at + F.col("vec_id") % 3).alias("until"), F.lit(1).alias("start"), F.lit(4).alias("end"))
    return contexts.span_pooled(tokens).select("i", "n_used", *((F.round(F.col("vec")[n], 6) + 0.0).alias(c) for n, c in enumerate("xy")))


@query(
    """WITH m AS (SELECT p, avg(x) AS m FROM (SELECT unnest(embedding)::double AS x, unnest(range(len(embedding))) AS p FROM embeddings) GROUP BY p),
    c AS (SELECT vec_id AS i, p, x - m AS x FROM (SELECT vec_id, unnest(embedding)::double AS x, unnest(range(len(embedding))) AS p FROM embeddings) JOIN m USING (p))
    SELECT a.i, round(sum(a.x * b.x) / sqrt(sum(a.x * a.x)) / sqrt(sum(b.x * b.x)), 5) + 0.0 AS cos FROM c a JOIN c b ON b.i = a.i + 1 AND a.p = b.p GROUP BY a.i"""
)
def pca_angles(spark: SparkSession, folder: str) -> DataFrame:
    """All components together keep the angles between centred vectors, whatever their signs."""
    v = _vectors(spark, folder)
    r = layout.pca_reduce(v, v.select(F.size("vec")).first()[0])
    other = r.select((F.col("i") - 1).alias("i"), F.col("vec").alias("w"))
    return r.join(other, "i").select("i", (F.round(V.dot(F.col("vec"), F.col("w")), 5) + 0.0).alias("cos"))
