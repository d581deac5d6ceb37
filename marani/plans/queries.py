"""The registered queries of the core, each over whole tables, with the DuckDB SQL that it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marani.functions import text as X
from marani.functions import vectors as V
from marani.functions.alphabet import GEORGIAN, SPACE
from marani.operators import corpus, emoji, evaluation, fields, layout, lookup, morph, neighbours, quality, vocab

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, and its SQL if it has any."""

    def add(f: Query) -> Query:
        REGISTRY[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- SQL that several oracles begin with

_L = GEORGIAN.letters


def _sql_sentences() -> str:
    t = "t"
    for a in sorted(GEORGIAN.abbreviations, key=len, reverse=True):
        t = f"replace({t}, '{a}', replace('{a}', '.', chr(1)))"
    initial = f"'(^|[^{_L}])([{_L}])\\.', '\\1\\2' || chr(1), 'g'"
    return f"""
WITH d AS (SELECT doc_id, trim(regexp_replace(text, '{SPACE}+', ' ', 'g')) AS t FROM documents),
p AS (SELECT doc_id, regexp_replace(regexp_replace({t}, {initial}), {initial}) AS t FROM d),
s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(t, '([.!?…]) ', '\\1' || chr(2), 'g'), chr(2)), lambda x: trim(replace(x, chr(1), '.'))), lambda x: x <> '') AS ss FROM p),
sent AS (SELECT doc_id, unnest(ss) AS sentence, unnest(range(len(ss))) AS sent_ix FROM s),
kept AS (SELECT * FROM sent WHERE len(string_split(sentence, ' ')) BETWEEN 4 AND 60 AND length(regexp_replace(sentence, '[^{_L}]', '', 'g')) / length(sentence) >= 0.6)
"""


_SENT = _sql_sentences()
_OCC = f"""
WITH raw AS (SELECT id AS sid, regexp_extract_all(text, '[{_L}]+') AS w FROM sentences WHERE text IS NOT NULL),
occ AS (SELECT sid, lower(unnest(w)) AS form, unnest(range(len(w))) AS pos FROM raw)
"""
_DELIVERED = "WITH o AS (SELECT DISTINCT lemma, sid, pos, form FROM occurrences)\n"


def _sql_stem(word: str) -> str:
    ending = "|".join(sorted(GEORGIAN.suffixes, key=len, reverse=True))
    return f"list_reduce(list_prepend({word}, list_transform(range(greatest(length({word}) - {GEORGIAN.min_stem}, 1)), lambda n: '')), lambda a, x: regexp_replace(a, '^(.{{{GEORGIAN.min_stem},}}?)(?:{ending})$', '\\1'))"


_UNIT = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::double) AS e FROM embeddings),
u AS (SELECT vec_id, label, list_transform(e, lambda x: x / CASE WHEN list_sum(list_transform(e, lambda y: y * y)) = 0 THEN 1 ELSE sqrt(list_sum(list_transform(e, lambda y: y * y))) END) AS u FROM v)
"""
_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1] * z[2]))"


# ---------------------------------------------------------------- text


@query(_SENT + f"SELECT lower(token) AS token, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(sentence, '[{_L}]+')) AS token FROM kept) GROUP BY 1")
def token_frequency(spark: SparkSession, folder: str) -> DataFrame:
    kept = corpus.kept_sentences(_table(spark, folder, "documents"))
    return vocab.token_frequency(vocab.occurrences(kept, "doc_id", "sentence")).withColumnRenamed("form", "token")


@query(_SENT + "SELECT * FROM sent")
def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.sentences(_table(spark, folder, "documents"))


@query(_SENT + "SELECT * FROM kept")
def sentence_keep_filter(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.kept_sentences(_table(spark, folder, "documents"))


@query(_SENT + "SELECT row_number() OVER (ORDER BY doc_id, sent_ix) - 1 AS id, * FROM (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY sentence ORDER BY doc_id, sent_ix) = 1)")
def sentence_dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    kept = corpus.kept_sentences(_table(spark, folder, "documents"))
    return corpus.dense_ids(corpus.first_of(kept, "sentence", ["doc_id", "sent_ix"]), ["doc_id", "sent_ix"])


@query(f"SELECT lower(lang) AS lang, count(*) AS docs, round(avg(CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^{_L}]', '', 'g')) / length(text) ELSE 0 END), 6) AS ratio FROM documents GROUP BY 1")
def letter_ratio_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    d = _table(spark, folder, "documents")
    return d.groupBy(F.lower("lang").alias("lang")).agg(F.count(F.lit(1)).alias("docs"), F.round(F.avg(X.letter_ratio(F.col("text"))), 6).alias("ratio"))


@query("SELECT i, word, nfc_normalize(word) AS nfc FROM vocab")
def nfc_words(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "vocab").select("i", "word", X.nfc("word").alias("nfc"))


@query(f"SELECT DISTINCT word, {_sql_stem('word')} AS stem FROM vocab WHERE word IS NOT NULL")
def stem_fixpoint(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "vocab").where("word IS NOT NULL").select("word").distinct().select("word", X.stem(F.col("word")).alias("stem"))


_WINDOW = f"""
WITH o AS (SELECT DISTINCT sid, pos, form FROM occurrences WHERE form IS NOT NULL AND form <> ''),
j AS (SELECT o.sid, o.pos, o.form, coalesce(s.text, '') AS t, length(o.form) AS n FROM o LEFT JOIN sentences s ON o.sid = s.id),
g AS (SELECT *, '(?s)^(.*?)(^|[^{_L}])' || regexp_escape(form) || '([^{_L}]|$)' AS p FROM j),
a AS (SELECT *, CASE WHEN regexp_matches(t, p) THEN length(regexp_extract(t, p, 1)) + length(regexp_extract(t, p, 2)) ELSE instr(t, form) - 1 END AS s0 FROM g),
b AS (SELECT *, substr(t, 1, greatest(s0 - 240, 0)::int) AS ahead, instr(substr(t, (s0 + n + 241)::int), ' ') AS behind FROM a WHERE s0 >= 0),
c AS (SELECT *, CASE WHEN contains(ahead, ' ') THEN length(ahead) - instr(reverse(ahead), ' ') + 1 ELSE 0 END AS lo, CASE WHEN behind = 0 THEN length(t) ELSE s0 + n + 239 + behind END AS hi FROM b)
SELECT sid, pos, form, 'title: none | text: ' || substr(t, lo + 1, (hi - lo)::int) AS text, (s0 - lo + 20)::int AS start, (s0 - lo + 20 + n)::int AS "end" FROM c
"""


def _window_rows(spark: SparkSession, folder: str) -> DataFrame:
    occ = _table(spark, folder, "occurrences").where("form IS NOT NULL AND form <> ''").select("sid", "pos", "form").distinct()
    window = X.input_window("title: none | text: {text}", F.col("text"), F.col("form"))
    made = vocab.with_context(occ, _table(spark, folder, "sentences")).withColumn("w", window).where("w IS NOT NULL")
    return made.select("sid", "pos", "form", "w.text", "w.start", "w.end")


@query(_WINDOW)
def input_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _window_rows(spark, folder)


def _clean(keep: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(text), '[^{X.OLD_LETTERS}{keep}]', ' ', 'g'), '{SPACE}+', ' ', 'g'))"


@query(f"SELECT doc_id, {_clean('.')} AS sentence_form, {_clean('0-9')} AS document_form, {_clean('')} AS article_form FROM documents")
def older_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    d = _table(spark, folder, "documents")
    return d.select("doc_id", *(X.cleanup(F.col("text"), k).alias(f"{k}_form") for k in ("sentence", "document", "article")))


_PAGES = f"""
WITH pages AS (
  SELECT doc_id, title, text FROM documents
  WHERE trim(regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g')) <> '' AND regexp_matches(text, '[{_L}]')
    AND NOT regexp_matches(coalesce(title, ''), '^({"|".join(X.NAMESPACES_DOCUMENT)})') AND NOT starts_with(text, '{X.REDIRECTS[0]}') AND NOT starts_with(text, '{X.REDIRECTS[1]}')
)
"""


@query(_PAGES + "SELECT doc_id FROM pages")
def real_pages(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").where(X.real_page(F.col("title"), F.col("text"), X.NAMESPACES_DOCUMENT)).select("doc_id")


@query(
    _PAGES
    + f"""SELECT doc_id, array_to_string(list_transform(ss, lambda s: array_to_string(s, ' ')), '.') AS text FROM (
      SELECT doc_id, list_filter(list_transform(string_split(c, '.'), lambda s: list_filter(string_split(s, ' '), lambda w: length(w) > 1)), lambda s: len(s) > 0) AS ss
      FROM (SELECT doc_id, {_clean(".")} AS c FROM (SELECT doc_id, coalesce(title, '') || '. ' || text AS text FROM pages)))"""
)
def older_sentence_corpus(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "documents").where(X.real_page(F.col("title"), F.col("text"), X.NAMESPACES_DOCUMENT))
    cut = X.token_sentences(X.cleanup(X.weave_title(F.col("title"), F.col("text")), "sentence"))
    return pages.select("doc_id", F.array_join(F.transform(cut, lambda s: F.array_join(s, " ")), ".").alias("text"))


@query(
    f"""SELECT article, array_to_string(w, ' ') AS text FROM (SELECT article, list_filter(string_split({_clean("")}, ' '), lambda x: length(x) > 1) AS w FROM (
      SELECT article, CASE WHEN article IS NULL THEN '' ELSE article || ' ' END || string_agg(coalesce(text, ''), ' ' ORDER BY id) AS text FROM sentences GROUP BY article)) WHERE len(w) > 1"""
)
def unit_corpus(spark: SparkSession, folder: str) -> DataFrame:
    s = _table(spark, folder, "sentences")
    return corpus.unit_corpus(s.select("id", "article", F.col("article").alias("title"), F.col("text").alias("line")), "article", "title")


@query("SELECT DISTINCT unnest(string_split(title, '')) AS character FROM documents WHERE title <> ''")
def title_characters(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.distinct_characters(_table(spark, folder, "documents"), "title")


@query("SELECT doc_id, title FROM documents WHERE contains(title, ':') AND NOT regexp_matches(title, '^(" + "|".join(X.NAMESPACES_DOCUMENT[:4]) + ")') ORDER BY md5('1|' || doc_id), doc_id LIMIT 100")
def colon_titles(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.random_rows(corpus.other_namespaces(_table(spark, folder, "documents")), 100, "doc_id").select("doc_id", "title")


@query("SELECT (SELECT max(length(p)) FROM (SELECT unnest(string_split(text, '.')) AS p FROM documents)) AS longest_piece, (SELECT count(DISTINCT w) FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)) AS distinct_words")
def piece_stats(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.piece_stats(_table(spark, folder, "documents"))


@query()
def markup_removed(spark: SparkSession, folder: str) -> DataFrame:
    d = _table(spark, folder, "documents")
    return d.select("doc_id", X.remove_markup(F.col("text")).alias("text"), X.is_redirect(F.col("text")).alias("is_redirect"))


# ---------------------------------------------------------------- runs, counts, vocabulary


@query(
    """SELECT user_id, group_ix, any_value(event_type) AS event_type, count(*) AS n, min(event_id) AS first_event FROM (
      SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1 AS group_ix FROM (
        SELECT *, CASE WHEN row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
    GROUP BY user_id, group_ix"""
)
def key_change_groups(spark: SparkSession, folder: str) -> DataFrame:
    runs = corpus.key_change_groups(_table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], ["event_type"])
    return runs.groupBy("user_id", "group_ix").agg(F.min("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


_VERSE = f"""
WITH l AS (SELECT id, article, id // 4 AS strophe, trim(trim(regexp_replace(text, '^{SPACE}+|{SPACE}+$', '', 'g')), '"') AS line FROM sentences),
g AS (SELECT *, sum(new) OVER (ORDER BY id ROWS UNBOUNDED PRECEDING) - 1 AS group_ix FROM (
  SELECT *, CASE WHEN row_number() OVER w = 1 OR article IS DISTINCT FROM lag(article) OVER w OR strophe IS DISTINCT FROM lag(strophe) OVER w THEN 1 ELSE 0 END AS new FROM l WINDOW w AS (ORDER BY id))),
j AS (SELECT article AS chapter_id, group_ix, min(id) AS first_line, article, trim(regexp_replace(string_agg(line, ' ' ORDER BY id), '{SPACE}+', ' ', 'g')) AS text FROM g WHERE length(line) > 0 GROUP BY 1, 2)
SELECT * FROM j WHERE length(text) > 0 AND length(regexp_replace(text, '[^{_L}]', '', 'g')) / length(text) >= 0.6
"""


@query(_VERSE)
def verse_strophes(spark: SparkSession, folder: str) -> DataFrame:
    s = _table(spark, folder, "sentences")
    return corpus.verse_sentences(s.select("id", F.col("text").alias("line"), F.col("article").alias("chapter"), F.col("article").alias("chapter_id"), F.expr("id div 4").alias("strophe_id")))


@query(_OCC + "SELECT form AS word, count(*) AS count, length(form) AS len FROM occ GROUP BY form")
def wordcount(spark: SparkSession, folder: str) -> DataFrame:
    s = _table(spark, folder, "sentences")
    return vocab.wordcount(s.select(F.transform(X.tokens(F.col("text")), X.fold).alias("tokens")), "tokens")


@query(
    f"""WITH g AS (SELECT coalesce(regexp_extract_all(text, '[{_L}]+'), []) AS w FROM sentences), t AS (SELECT unnest(w) AS x FROM g)
    SELECT max(len(w)) AS max_group_length, (SELECT max(length(x)) FROM t) AS max_word_length, (SELECT min(length(x)) FROM t) AS min_word_length,
      sum(len(w))::bigint AS total_words, count(*) AS total_groups, (SELECT count(DISTINCT x) FROM t) AS total_unique_words FROM g"""
)
def wordcount_stats(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.wordcount_stats(_table(spark, folder, "sentences").select(X.tokens(F.col("text")).alias("tokens")), "tokens")


@query(
    _OCC
    + """, n AS (SELECT form FROM occ GROUP BY form HAVING count(*) > 1)
    SELECT sid AS id, string_agg(form, ' ' ORDER BY pos) AS text FROM occ JOIN n USING (form) GROUP BY sid HAVING count(*) > 1"""
)
def hapax_prune(spark: SparkSession, folder: str) -> DataFrame:
    s = _table(spark, folder, "sentences").select("id", F.transform(X.tokens(F.col("text")), X.fold).alias("tokens"))
    return corpus.frequent_tokens(s, "id", "tokens").select("id", F.array_join("tokens", " ").alias("text"))


@query("SELECT form, min(lemma) AS lemma FROM occurrences WHERE form IS NOT NULL AND lemma IS NOT NULL GROUP BY form HAVING count(DISTINCT lemma) = 1")
def form_to_lemma(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.form_to_lemma(_table(spark, folder, "occurrences").select("form", "lemma"))


@query(
    _OCC
    + """, f AS (SELECT form, min(lemma) AS lemma FROM occurrences WHERE form IS NOT NULL AND lemma IS NOT NULL GROUP BY form HAVING count(DISTINCT lemma) = 1)
    SELECT lemma, count(*) AS freq FROM occ JOIN f USING (form) GROUP BY lemma"""
)
def lemma_frequency(spark: SparkSession, folder: str) -> DataFrame:
    forms = vocab.form_to_lemma(_table(spark, folder, "occurrences").select("form", "lemma"))
    return vocab.token_frequency(vocab.lemmatize(vocab.occurrences(_table(spark, folder, "sentences")), forms), "lemma")


_DRAW = "md5('20260704|' || coalesce(lemma, '?') || '|' || coalesce(sid::varchar, '?') || '|' || coalesce(pos::varchar, '?'))"


@query(_DELIVERED + f"SELECT lemma, sid, pos, form FROM o QUALIFY row_number() OVER (PARTITION BY lemma ORDER BY {_DRAW}, sid, pos) <= 400")
def reservoir_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.capped_occurrences(_table(spark, folder, "occurrences").select("lemma", "sid", "pos", "form").distinct())


@query(
    _DELIVERED
    + f""", c AS (SELECT o.*, coalesce(s.article, '') AS article, {_DRAW} AS k FROM o LEFT JOIN sentences s ON o.sid = s.id),
    a AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lemma, article ORDER BY k, sid, pos) <= 2)
    SELECT lemma, sid, pos, form, article FROM a QUALIFY row_number() OVER (PARTITION BY lemma ORDER BY k, sid, pos) <= 64"""
)
def capped_sample(spark: SparkSession, folder: str) -> DataFrame:
    occ = _table(spark, folder, "occurrences").select("lemma", "sid", "pos", "form").distinct()
    return vocab.sample_contexts(vocab.with_context(occ, _table(spark, folder, "sentences")).drop("text"), key="lemma").select("lemma", "sid", "pos", "form", "article")


@query("SELECT o.sid, o.pos, coalesce(s.article, '') AS article, length(coalesce(s.text, '')) AS chars FROM (SELECT DISTINCT sid, pos FROM occurrences) o LEFT JOIN sentences s ON o.sid = s.id")
def occurrence_context(spark: SparkSession, folder: str) -> DataFrame:
    occ = _table(spark, folder, "occurrences").select("sid", "pos").distinct()
    return vocab.with_context(occ, _table(spark, folder, "sentences")).select("sid", "pos", "article", F.length("text").alias("chars"))


_DOMINANT = """, n AS (SELECT lemma, form, count(*) AS n, min((sid, pos)) AS first FROM o WHERE form IS NOT NULL GROUP BY lemma, form),
label AS (SELECT lemma, form AS word FROM n QUALIFY row_number() OVER (PARTITION BY lemma ORDER BY n DESC, first, form) = 1)
"""


@query(_DELIVERED + _DOMINANT + "SELECT * FROM label")
def dominant_form(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.dominant_form(_table(spark, folder, "occurrences").select("lemma", "sid", "pos", "form").distinct().where("form IS NOT NULL"))


_SELECTED = f"""{_DELIVERED}{_DOMINANT}, f AS (SELECT lemma, count(*) AS freq FROM o GROUP BY lemma),
j AS (SELECT coalesce(word, f.lemma) AS word, f.lemma, freq FROM f LEFT JOIN label ON f.lemma = label.lemma WHERE freq >= 8),
good AS (SELECT * FROM j WHERE regexp_full_match(lemma, '[{_L}]+') AND regexp_full_match(word, '[{_L}]+') AND length(lemma) >= 2 AND length(word) >= 2
  AND lemma NOT IN (SELECT unnest(terms_ka) FROM subjects) AND word NOT IN (SELECT unnest(terms_ka) FROM subjects)),
v AS (SELECT row_number() OVER (ORDER BY freq DESC, lemma) - 1 AS i, * FROM good ORDER BY freq DESC, lemma LIMIT 30000)
"""


def _selected(spark: SparkSession, folder: str) -> DataFrame:
    occ = _table(spark, folder, "occurrences").select("lemma", "sid", "pos", "form").distinct()
    listed = _table(spark, folder, "subjects").select(F.explode("terms_ka").alias("word"))
    return vocab.select_vocabulary(vocab.token_frequency(occ, "lemma"), vocab.dominant_form(occ.where("form IS NOT NULL")), listed)


@query(_SELECTED + "SELECT i, word, lemma, freq FROM v")
def vocab_select(spark: SparkSession, folder: str) -> DataFrame:
    return _selected(spark, folder)


@query(_SELECTED + "SELECT sha256(string_agg(word, chr(10) ORDER BY i)) AS vocab_hash FROM v")
def vocab_hash(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.vocabulary_hash(_selected(spark, folder))


@query(
    f"""WITH r AS (SELECT i, word, coalesce(freq, 0) AS freq, coalesce(len(occ), 0) AS n, {_sql_stem("word")} AS lemma FROM vocab WHERE word IS NOT NULL),
    g AS (SELECT lemma, min((-freq, word, i)) AS m, sum(freq)::bigint AS freq, least(sum(n), 400)::int AS n_occ FROM r GROUP BY lemma)
    SELECT row_number() OVER (ORDER BY g.freq DESC, r.word, r.i) - 1 AS i, r.word, g.lemma, g.freq, g.n_occ, r.i AS src_i FROM g JOIN r ON g.lemma = r.lemma AND g.m = (-r.freq, r.word, r.i)"""
)
def collapse_roots(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.collapse(_table(spark, folder, "vocab")).select("i", "word", "lemma", "freq", F.size("occ").alias("n_occ"), "src_i")


@query("SELECT i, word FROM vocab WHERE word IS NULL OR word NOT IN (SELECT lower(unnest(terms_ka)) FROM subjects)")
def stopword_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    listed = _table(spark, folder, "subjects").select(F.explode("terms_ka").alias("word"))
    return vocab.without_words(_table(spark, folder, "vocab").select("i", "word"), listed, "word")


# ---------------------------------------------------------------- vectors


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "embeddings").select(F.col("vec_id").alias("i"), F.col("embedding").cast("array<double>").alias("vec"), "label")


def _digits(c: str, n: int = 6) -> F.Column:
    return (F.round(c, n) + 0.0).alias(c)


@query(_UNIT + "SELECT vec_id AS i, p, round(x, 6) + 0.0 AS x FROM (SELECT vec_id, unnest(u) AS x, unnest(range(len(u))) AS p FROM u)")
def l2_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select("i", F.posexplode(V.l2_normalize(F.col("vec"))).alias("p", "x")).select("i", "p", _digits("x"))


@query(
    _UNIT
    + """SELECT vec_id AS i, p, round(x, 6) + 0.0 AS x FROM (SELECT vec_id, unnest(list_transform(e[1:32], lambda x: x / sqrt(list_sum(list_transform(e[1:32], lambda y: y * y))))) AS x, unnest(range(32)) AS p FROM v)"""
)
def prefix_reduce(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select("i", F.posexplode(V.prefix_reduce(F.col("vec"), 32)).alias("p", "x")).select("i", "p", _digits("x"))


_NEAR = f"""{_UNIT}, pairs AS (SELECT a.vec_id AS i, b.vec_id AS j, {_DOT.format("a.u", "b.u")} AS cos FROM u a, u b WHERE a.vec_id <> b.vec_id),
near AS (SELECT i, j, cos, row_number() OVER (PARTITION BY i ORDER BY round(cos, 12) DESC, j) - 1 AS rank FROM pairs QUALIFY rank < 15)
"""


@query(_NEAR + "SELECT i, rank, j, round_even(greatest(least(cos, 1), 0) * 255, 0)::int AS sim_u8 FROM near")
def exact_topk_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.exact_neighbours(_vectors(spark, folder)).select("i", "rank", "j", F.col("sim_u8").cast("int").alias("sim_u8"))


_QUANT = """, s AS (SELECT vec_id, e, CASE WHEN list_max(list_transform(e, lambda x: abs(x))) = 0 THEN 1 ELSE list_max(list_transform(e, lambda x: abs(x))) / 127 END AS scale FROM v),
q AS (SELECT vec_id, scale, list_transform(e, lambda x: greatest(least(round_even(x / scale, 0), 127), -127)) AS q FROM s)
"""


@query(_UNIT + _QUANT + "SELECT vec_id AS i, round(scale, 9) AS scale, unnest(q)::int AS q, unnest(range(len(q))) AS p FROM q")
def quantize_int8(spark: SparkSession, folder: str) -> DataFrame:
    z = _vectors(spark, folder).select("i", V.quantize_i8(F.col("vec")).alias("z"))
    return z.select("i", F.round("z.scale", 9).alias("scale"), F.posexplode("z.q").alias("p", "q")).select("i", "scale", F.col("q").cast("int").alias("q"), "p")


@query(_UNIT + _QUANT + f"SELECT a.vec_id AS i, round({_DOT.format('a.q', 'b.q')} * a.scale * b.scale, 6) + 0.0 AS cos FROM q a JOIN q b ON b.vec_id = a.vec_id + 1")
def int8_cosine(spark: SparkSession, folder: str) -> DataFrame:
    z = _vectors(spark, folder).select("i", V.quantize_i8(F.col("vec")).alias("z"))
    other = z.select((F.col("i") - 1).alias("i"), F.col("z").alias("y"))
    return z.join(other, "i").select("i", V.int8_cosine(F.col("z"), F.col("y")).alias("cos")).select("i", _digits("cos"))


_CENTROID = """
WITH x AS (SELECT label, unnest(embedding)::double AS x, unnest(range(len(embedding))) AS p FROM embeddings),
m AS (SELECT label, p, avg(x) AS x FROM x GROUP BY label, p)
SELECT label, p, round(x / CASE WHEN n = 0 THEN 1 ELSE n END, 6) + 0.0 AS x FROM m JOIN (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY label) USING (label)
"""


@query(_CENTROID)
def centroid_by_label(spark: SparkSession, folder: str) -> DataFrame:
    means = _vectors(spark, folder).select("label", F.posexplode("vec").alias("p", "x")).groupBy("label", "p").agg(F.avg("x").alias("x"))
    whole = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "x"))), lambda y: y["x"]).alias("v"))
    return whole.select("label", F.posexplode(V.l2_normalize(F.col("v"))).alias("p", "x")).select("label", "p", _digits("x"))


_EMOJI = f"""
WITH k AS (SELECT row_id, list_filter(list_transform(string_split(keywords_ka, '|'), lambda x: regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda x: x <> '') AS ks FROM emoji_keywords),
kw AS (SELECT row_id, unnest(ks) AS keyword, unnest(range(len(ks))) AS rank FROM k),
w AS (SELECT word, min(i) AS i FROM vocab WHERE word IS NOT NULL GROUP BY word),
hit AS (SELECT row_id, keyword, pow(0.65, rank) AS base, i FROM kw LEFT JOIN w ON keyword = word),
tok AS (SELECT row_id, base, unnest(list_filter(regexp_split_to_array(keyword, '{SPACE}+'), lambda x: x <> '')) AS token FROM hit WHERE i IS NULL),
m AS (SELECT row_id, i, max(weight) AS weight FROM (SELECT row_id, i, base AS weight FROM hit WHERE i IS NOT NULL UNION ALL SELECT row_id, w.i, base * 0.5 FROM tok JOIN w ON token = word) GROUP BY row_id, i)
"""


def _matches(spark: SparkSession, folder: str) -> DataFrame:
    k = _table(spark, folder, "emoji_keywords").select("row_id", F.posexplode(emoji.plain_keywords(F.col("keywords_ka"))).alias("rank", "keyword"))
    return emoji.match_words(k, _table(spark, folder, "vocab"), "row_id")


@query(_EMOJI + "SELECT row_id, i, round(weight, 9) AS weight FROM m")
def emoji_match(spark: SparkSession, folder: str) -> DataFrame:
    return _matches(spark, folder).select("row_id", "i", _digits("weight", 9))


_USABLE = "SELECT i, min(vec128) AS v FROM layout WHERE len(vec128) = 128 AND len(list_filter(vec128, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 GROUP BY i"


def _usable(spark: SparkSession, folder: str) -> DataFrame:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = _table(spark, folder, "layout").where((F.size("vec128") == 128) & ~F.exists("vec128", bad))
    return good.groupBy("i").agg(F.min("vec128").alias("vec"))


@query(
    _EMOJI
    + f""", v AS ({_USABLE}),
    j AS (SELECT m.row_id, m.weight, coalesce(vocab.freq, 0) AS f, v.v FROM m JOIN v ON m.i = v.i LEFT JOIN vocab ON m.i = vocab.i),
    x AS (SELECT row_id, p, sum(weight * x) / sum(weight) AS x, max(f) AS f FROM (SELECT row_id, weight, f, unnest(v)::double AS x, unnest(range(128)) AS p FROM j) GROUP BY row_id, p)
    SELECT row_id, p, round(x / n, 5) + 0.0 AS x, f AS freq FROM x JOIN (SELECT row_id, sqrt(sum(x * x)) AS n FROM x GROUP BY row_id) USING (row_id) WHERE n > 0"""
)
def emoji_compose(spark: SparkSession, folder: str) -> DataFrame:
    made = emoji.compose(_matches(spark, folder), _usable(spark, folder), _table(spark, folder, "vocab"), "row_id")
    return made.select("row_id", "freq", F.posexplode("vec").alias("p", "x")).select("row_id", "p", _digits("x", 5), "freq")


# ---------------------------------------------------------------- layouts


def _points(spark: SparkSession, folder: str, first: int) -> DataFrame:
    return _vectors(spark, folder).select("i", F.col("vec")[first].alias("x"), F.col("vec")[first + 1].alias("y"))


_P = "WITH a AS (SELECT vec_id AS i, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings), r AS (SELECT vec_id AS i, embedding[3]::double AS u, embedding[4]::double AS v FROM embeddings)\n"


@query(_P + "SELECT round((max(x) + min(x)) / 2, 9) AS cx, round((max(y) + min(y)) / 2, 9) AS cy, round(1 / greatest(greatest((max(x) - min(x)) / 2, (max(y) - min(y)) / 2), 1e-9), 6) AS scale FROM a")
def bounding_box(spark: SparkSession, folder: str) -> DataFrame:
    return layout.bounding_box(_points(spark, folder, 0)).select(_digits("cx", 9), _digits("cy", 9), _digits("scale"))


_PROCRUSTES = """, m AS (SELECT avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv FROM a JOIN r USING (i)),
s AS (SELECT sum((x - mx) * (u - mu)) AS xu, sum((x - mx) * (v - mv)) AS xv, sum((y - my) * (u - mu)) AS yu, sum((y - my) * (v - mv)) AS yv, sum((x - mx) ** 2 + (y - my) ** 2) AS size FROM a JOIN r USING (i), m),
t AS (SELECT *, sqrt((xu + yv) ** 2 + (xv - yu) ** 2) AS rot, sqrt((xu - yv) ** 2 + (xv + yu) ** 2) AS ref FROM s),
o AS (SELECT CASE WHEN rot >= ref THEN (xu + yv) / rot ELSE (xu - yv) / ref END AS c, CASE WHEN rot >= ref THEN (xv - yu) / rot ELSE (xv + yu) / ref END AS n, CASE WHEN rot >= ref THEN 1 ELSE -1 END AS g, greatest(rot, ref) / size AS k FROM t),
z AS (SELECT i, ((x - mx) * c - (y - my) * n * g) * k + mu AS x, ((x - mx) * n + (y - my) * c * g) * k + mv AS y FROM a, m, o)
"""


@query(_P + _PROCRUSTES + "SELECT i, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y FROM z")
def procrustes_align(spark: SparkSession, folder: str) -> DataFrame:
    return layout.procrustes(_points(spark, folder, 0), _points(spark, folder, 2)).select("i", _digits("x"), _digits("y"))


@query(_P + _PROCRUSTES + ", d AS (SELECT sqrt((x - u) ** 2 + (y - v) ** 2) AS d FROM z JOIN r USING (i)) SELECT round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.95), 6) AS p95 FROM d")
def displacement_stats(spark: SparkSession, folder: str) -> DataFrame:
    reference = _points(spark, folder, 2)
    return layout.displacement(layout.procrustes(_points(spark, folder, 0), reference), reference).select(_digits("median"), _digits("p95"))


@query()
def pca_reduce(spark: SparkSession, folder: str) -> DataFrame:
    return layout.pca_reduce(_vectors(spark, folder), 16).select("i", F.posexplode("vec").alias("p", "x"))


@query()
def umap_layout(spark: SparkSession, folder: str) -> DataFrame:
    return layout.fit_box(layout.umap_layout(_vectors(spark, folder), 15))


# ---------------------------------------------------------------- evaluation and lookup

_ANALOGIES = [("0", "1", "2", "3"), ("10", "11", "12", "13"), ("20", "21", "22", "23"), ("30", "31", "32", "33"), ("40", "41", "41", "43")]
_Q = "q(a, b, c, d) AS (VALUES " + ", ".join(str(x) for x in _ANALOGIES) + ")"
_TARGET = f"""{_UNIT}, w AS (SELECT vec_id::varchar AS word, u FROM u), {_Q},
t0 AS (SELECT q.*, list_transform(list_zip(ub.u, uc.u, ua.u), lambda z: z[1] + z[2] - z[3]) AS t FROM q JOIN w ua ON ua.word = a JOIN w ub ON ub.word = b JOIN w uc ON uc.word = c),
t AS (SELECT a, b, c, d, list_transform(t, lambda x: x / sqrt(list_sum(list_transform(t, lambda y: y * y)))) AS t FROM t0),
s AS (SELECT a, b, c, d, word, round({_DOT.format("t.t", "w.u")}, 9) AS score FROM t, w WHERE word NOT IN (a, b, c)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY a, b, c, d ORDER BY score DESC, word) - 1 AS rank FROM s)
"""


def _words(spark: SparkSession, folder: str) -> DataFrame:
    return _vectors(spark, folder).select(F.col("i").cast("string").alias("word"), "vec")


def _asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_ANALOGIES, "a string, b string, c string, d string")


@query(_TARGET + "SELECT a, b, c, rank, word AS candidate, round(score, 6) + 0.0 AS score FROM ranked WHERE rank < 10")
def analogy_topk(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.analogy_topk(_asked(spark), _words(spark, folder)).select("a", "b", "c", "rank", "candidate", _digits("score"))


@query(_TARGET + "SELECT q.a, q.b, q.c, q.d, coalesce(rank, -1) AS rank FROM q LEFT JOIN ranked r ON q.a = r.a AND q.b = r.b AND q.c = r.c AND q.d = r.d AND r.word = q.d")
def analogy_rank(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.analogy_rank(_asked(spark), _words(spark, folder))


@query(_TARGET + 'SELECT (SELECT count(*) FROM q) AS asked, count(*) AS known, count_if(rank = 0) AS "right", round(coalesce(count_if(rank = 0) / nullif(count(*), 0), 0), 6) AS accuracy FROM ranked WHERE word = d')
def analogy_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.analogy_accuracy(_asked(spark), _words(spark, folder)).select("asked", "known", "right", _digits("accuracy"))


_RELATED = f"""{_UNIT}, w AS (SELECT vec_id::varchar AS word, u, label FROM u),
asked AS (SELECT s.word AS subject, t.word AS term FROM w s JOIN w t ON s.label = t.label AND s.word <> t.word WHERE s.word IN ('0', '7', '14')),
ranked AS (SELECT s.word AS subject, w.word AS term, row_number() OVER (PARTITION BY s.word ORDER BY round({_DOT.format("s.u", "w.u")}, 9) DESC, w.word) - 1 AS rank FROM w s, w WHERE s.word IN ('0', '7', '14') AND s.word <> w.word)
"""


def _related(spark: SparkSession, folder: str) -> DataFrame:
    v = _vectors(spark, folder).select(F.col("i").cast("string").alias("word"), "label")
    s = v.where(F.col("word").isin("0", "7", "14")).select(F.col("word").alias("subject"), "label")
    return v.join(F.broadcast(s), "label").where("word <> subject").select("subject", F.col("word").alias("term"))  # of three subjects


@query(_RELATED + "SELECT asked.subject, asked.term, rank FROM asked JOIN ranked USING (subject, term)")
def related_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.related_ranks(_related(spark, folder), _words(spark, folder))


_SCORES = f"""{_RELATED}, {_Q}, two AS (SELECT * FROM q UNION SELECT c, d, a, b FROM q),
t0 AS (SELECT two.*, list_transform(list_zip(ub.u, uc.u, ua.u), lambda z: z[1] + z[2] - z[3]) AS t FROM two JOIN w ua ON ua.word = a JOIN w ub ON ub.word = b JOIN w uc ON uc.word = c),
t AS (SELECT a, b, c, d, list_transform(t, lambda x: x / sqrt(list_sum(list_transform(t, lambda y: y * y)))) AS t FROM t0),
ar AS (SELECT a, b, c, d, word, row_number() OVER (PARTITION BY a, b, c, d ORDER BY round({_DOT.format("t.t", "w.u")}, 9) DESC, word) - 1 AS rank FROM t, w WHERE word NOT IN (a, b, c)),
aa AS (SELECT round(1 - avg(coalesce(ar.rank, -1)) / (SELECT count(*) FROM w), 4) AS score FROM two LEFT JOIN ar ON two.a = ar.a AND two.b = ar.b AND two.c = ar.c AND two.d = ar.d AND ar.word = two.d),
rr AS (SELECT avg(s) AS score FROM (SELECT round(1 - avg(rank) / (SELECT count(*) FROM w), 4) AS s FROM asked JOIN ranked USING (subject, term) GROUP BY subject))
SELECT round(aa.score, 6) AS analogy, round(rr.score, 6) AS related, round((aa.score + rr.score) / 2, 6) AS score FROM aa, rr
"""


@query(_SCORES)
def model_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    w = _words(spark, folder)
    both = evaluation.evaluate(evaluation.analogy_evaluation(_asked(spark), w), evaluation.related_evaluation(_related(spark, folder), w))
    return both.select(*(_digits(c) for c in ("analogy", "related", "score")))


_PROBES = f"""
WITH v AS (SELECT i, {_sql_stem("word")} AS root FROM vocab WHERE word IS NOT NULL),
f AS (SELECT root, min(i) AS i FROM v GROUP BY root),
n AS (SELECT DISTINCT l.i, unnest(nidx) AS j FROM layout l),
p AS (SELECT subject, unnest(terms_ka) AS word, terms_ka AS expected FROM subjects),
x AS (SELECT subject, word, {_sql_stem("word")} AS root, list_filter(list_transform(expected, lambda e: {_sql_stem("e")}), lambda e: e <> {_sql_stem("word")}) AS expected FROM p),
m AS (SELECT x.subject, x.word, f.i IS NOT NULL AS present, coalesce(bool_or(list_contains(x.expected, v.root)), false) AS hit
  FROM x LEFT JOIN f ON x.root = f.root LEFT JOIN n ON n.i = f.i LEFT JOIN v ON v.i = n.j GROUP BY ALL)
SELECT count(*) AS probes, sum(present::int)::bigint AS present, sum(hit::int)::bigint AS hits, 0::bigint AS forbidden, round(CASE WHEN sum(present::int) > 0 THEN sum(hit::int) / sum(present::int) ELSE 0 END, 6) AS hit_rate FROM m
"""


@query(_PROBES)
def probe_hit_rate(spark: SparkSession, folder: str) -> DataFrame:
    p = _table(spark, folder, "subjects").select(F.explode("terms_ka").alias("word"), F.col("terms_ka").alias("expected"))
    own = X.stem(F.col("word"))
    p = p.select("word", F.filter("expected", lambda e: X.stem(e) != own).alias("expected"), F.array().cast("array<string>").alias("forbidden"))
    near = _table(spark, folder, "layout").select("i", F.explode("nidx").alias("j")).distinct()
    return evaluation.probe_metrics(p, _table(spark, folder, "vocab"), near).withColumn("hit_rate", F.round("hit_rate", 6))


@query(
    f"""{_UNIT}, q AS (SELECT vec_id AS q, u AS qu FROM u WHERE vec_id % 100 = 0),
    c AS (SELECT q, vec_id AS i, {_DOT.format("qu", "u")} AS cos FROM u, q),
    n AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY q ORDER BY round(cos, 9) DESC, i) <= 8),
    w AS (SELECT n.*, exp((cos - max(cos) OVER (PARTITION BY q)) / 0.05) AS w, embedding[1]::double AS x, embedding[2]::double AS y FROM n JOIN embeddings ON vec_id = i)
    SELECT q, round(sum(w * x) / sum(w), 6) + 0.0 AS x, round(sum(w * y) / sum(w), 6) + 0.0 AS y FROM w GROUP BY q"""
)
def knn_pin(spark: SparkSession, folder: str) -> DataFrame:
    v = _vectors(spark, folder)
    asked = v.where(F.col("i") % 100 == 0).select(F.col("i").alias("q"), F.col("vec").alias("qv"))
    return lookup.pin(asked, v.select("i", "vec"), _points(spark, folder, 0)).select("q", _digits("x"), _digits("y"))


@query("SELECT i, word, freq FROM vocab WHERE starts_with(lower(word), 'სა') ORDER BY freq DESC NULLS LAST, word, i LIMIT 20")
def prefix_search(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.prefix_search(_table(spark, folder, "vocab").select("i", "word", "freq"), "სა")


# DuckDB counts edits of bytes, so the oracle writes each Georgian letter as one byte.
_BYTES = "translate(lower({}), 'აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&*+')"


@query(f"SELECT i, word, distance FROM (SELECT i, word, freq, levenshtein({_BYTES.format('word')}, {_BYTES.format("'მდინარე'")}) AS distance FROM vocab) WHERE distance <= 3 ORDER BY distance, freq DESC NULLS LAST, word, i LIMIT 20")
def fuzzy_search(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.fuzzy_search(_table(spark, folder, "vocab").select("i", "word", "freq"), "მდინარე", 3).select("i", "word", "distance")


@query("WITH b AS (SELECT i, min(nidx) AS nidx FROM layout WHERE nidx IS NOT NULL GROUP BY i), r AS (SELECT i, unnest(nidx) AS j, unnest(range(len(nidx))) AS rank FROM b) SELECT rank, j, word FROM r JOIN vocab ON vocab.i = j WHERE r.i = 1")
def related_words(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "layout").where("nidx IS NOT NULL").groupBy("i").agg(F.min("nidx").alias("nidx"))
    near = rows.select("i", F.posexplode("nidx").alias("rank", "j")).withColumn("sim_u8", F.lit(0))
    return lookup.related_words(near, _table(spark, folder, "vocab"), 1).select("rank", "j", "word")


@query(_P + "SELECT a.i, round(x + (u - x) * 0.256, 9) + 0.0 AS x, round(y + (v - y) * 0.256, 9) + 0.0 AS y FROM a JOIN r USING (i)")
def morph_points(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.morph(_points(spark, folder, 0), _points(spark, folder, 2), 0.4).select("i", _digits("x", 9), _digits("y", 9))


# ---------------------------------------------------------------- published data and its gate


@query("WITH b AS (SELECT i, min(nidx) AS nidx, min(nsim) AS nsim FROM layout WHERE len(nidx) = len(nsim) GROUP BY i) SELECT i, unnest(range(len(nidx))) AS rank, unnest(nidx) AS j, unnest(nsim) AS sim_u8 FROM b")
def packed_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "layout").where("size(nidx) = size(nsim)").groupBy("i").agg(F.min("nidx").alias("nidx"), F.min("nsim").alias("nsim"))
    each = rows.select("i", F.posexplode(F.arrays_zip("nidx", "nsim")).alias("rank", "z")).select("i", "rank", F.col("z.nidx").alias("j"), F.col("z.nsim").alias("sim_u8"))
    wide = neighbours.index_bytes(_table(spark, folder, "layout").select(F.explode("nidx").alias("j")))
    return neighbours.unpack_neighbours(neighbours.pack_neighbours(each, wide), wide).select("i", "rank", "j", F.col("sim_u8").cast("int").alias("sim_u8"))


@query(
    """SELECT 'finite' AS "check", 'vec128:' || i AS detail FROM layout WHERE vec128 IS NULL OR len(list_filter(vec128, lambda x: x IS NULL OR isnan(x) OR isinf(x))) > 0
    UNION ALL SELECT 'neighbour_range', i || ':' || j FROM (SELECT i, unnest(nidx) AS j FROM layout) WHERE NOT j BETWEEN 0 AND (SELECT count(*) FROM vocab) - 1
    UNION ALL SELECT 'listed_word', word FROM vocab WHERE lower(word) IN (SELECT lower(unnest(terms_ka)) FROM subjects)
    UNION ALL SELECT 'equal_counts', (SELECT count(*) FROM layout) || '/' || (SELECT count(*) FROM vocab) WHERE (SELECT count(*) FROM layout) <> (SELECT count(*) FROM vocab)
    UNION ALL SELECT 'vocabulary_ceiling', (SELECT count(*) FROM vocab)::varchar WHERE (SELECT count(*) FROM vocab) > 65535"""
)
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    rows, words = _table(spark, folder, "layout"), _table(spark, folder, "vocab")
    listed = _table(spark, folder, "subjects").select(F.explode("terms_ka").alias("word"))
    near = rows.select("i", F.explode("nidx").alias("j"))
    return quality.gate(
        quality.finite(rows, "vec128"), quality.neighbours_in_range(near, words.count()), quality.no_listed_words(words, listed), quality.equal_counts(rows, words), quality.at_most(words)
    )


@query()
def html_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    d = _table(spark, folder, "documents").where("text IS NOT NULL")
    page = F.concat(F.lit("<html><body><table><tr><td><p>x</p></td></tr></table><p>"), F.regexp_replace("text", "\n", "</p><p>"), F.lit("</p></body></html>"))
    return corpus.page_paragraphs(d.select("doc_id", page.alias("html")), "doc_id")


# A few rules in the form of an affix file, with a circumfix.
SMALL_AFFIXES = """
FLAG long
FORBIDDENWORD &!
NEEDAFFIX &v
CIRCUMFIX &x
SFX NA Y 2
SFX NA 0 ს [აეიოუ]
SFX NA ი ის ი
SFX NB Y 1
SFX NB 0 ში .
SFX VC Y 1
SFX VC ი ეთ/&xpA ი
PFX pA Y 1
PFX pA 0 სა/&x .
PFX pB Y 1
PFX pB 0 უ .
"""


@query()
def affix_expand(spark: SparkSession, folder: str) -> DataFrame:
    flags = F.array(F.lit("NA"), F.lit("NB"), F.lit("VC"), F.lit("pB"))
    stems = _table(spark, folder, "vocab").where("lemma IS NOT NULL").select(F.col("lemma").alias("stem"), flags.alias("flags")).distinct()
    return vocab.form_to_lemma(morph.form_lemma_pairs(morph.expand(stems, morph.parse_affixes(SMALL_AFFIXES))))


@query()
def word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    s = _table(spark, folder, "sentences").select(F.transform(X.tokens(F.col("text")), X.fold).alias("tokens")).where("size(tokens) > 0")
    return evaluation.train_word_vectors(s, size=32).select("word", F.posexplode("vec").alias("p", "x"))


@query(
    f"""WITH s AS (SELECT DISTINCT text FROM sentences WHERE text IS NOT NULL)
    SELECT lower(token) AS token, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '[{_L}]+')) AS token FROM s) GROUP BY 1"""
)
def streaming_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from marani.streaming import counts

    rows = _table(spark, folder, "sentences")
    name = f"{folder}/sentences.parquet"
    reader = spark.readStream.schema(rows.schema)
    one_file = rows.inputFiles()[0].endswith("/sentences.parquet")
    stream = reader.option("pathGlobFilter", "sentences.parquet").parquet(folder) if one_file else reader.parquet(name)
    return counts.run_to_end(counts.token_counts(counts.distinct_sentences(stream)), "tokens")


@query()
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return fields.unpack(_table(spark, folder, "emoji_keywords"))


from . import rounds  # noqa: E402, F401 - registers further queries
