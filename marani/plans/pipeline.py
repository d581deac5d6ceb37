"""The stages from text to a published dataset. Each reads tables and writes tables; none depends on the order of files."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.alphabet import GEORGIAN, Alphabet
from ..operators import contexts, corpus, emoji, evaluation, layout, morph, neighbours, quality, vocab
from ..runtime import settle
from ..sources import sinks


@dataclass(frozen=True)
class Settings:
    """What the stages take as parameters; ``of`` reads them from the configurations of a dataset and of its corpus."""

    id: str = "dataset"
    corpus: str | None = None
    name_ka: str = ""
    name_en: str = ""
    model: str | None = None
    revision: str = "main"
    min_words: int = 4
    max_words: int | None = 60
    min_ratio: float = 0.6
    abbreviations: tuple[str, ...] = GEORGIAN.abbreviations
    group_by: tuple[str, ...] = ("chapter_id", "strophe_id")
    min_occurrences: int = 8
    target: int = 30_000
    affixes: str | None = None
    lemma_sources: tuple[str, ...] = ()
    word_lists: tuple[str, ...] = ()
    contexts: int = 64
    per_article: int = 2
    sample_seed: int = vocab.SEED
    template: str = "{text}"
    layer: str | float | None = None
    window_tokens: int = 96
    reduce: str = "mrl"
    dimensions: int = 128
    aligned_group: str | None = None
    reference: str | None = None
    neighbours: int = 15
    umap: dict = field(default_factory=lambda: {"n_neighbors": 30, "min_dist": 0.08, "seed": 20260704})

    @classmethod
    def of(cls, *configs: dict) -> Settings:
        """A key that a configuration doesn't have keeps its default, or what an earlier configuration says."""
        flat = {}
        for config in configs:
            for part, names in KEYS.items():
                own = config.get(part) or {} if part else config
                flat |= {name: own[key] for key, name in names.items() if own.get(key) is not None}
        if "least_frequency" in flat:
            flat["min_occurrences"] = max(flat.pop("least_frequency"), flat.get("min_occurrences", cls.min_occurrences))
        if "umap" in flat:
            flat["umap"] = {k: v for k, v in flat["umap"].items() if k in ("n_neighbors", "min_dist", "seed")} or cls().umap
        lists = [flat.pop(k) for k in ("blocklist", "stopwords") if k in flat]
        flat |= {k: tuple(flat[k]) for k in ("abbreviations", "group_by", "lemma_sources") if k in flat}
        return cls(**flat, **({"word_lists": tuple(lists)} if lists else {}))

    @property
    def alphabet(self) -> Alphabet:
        return replace(GEORGIAN, abbreviations=self.abbreviations)

    def described(self) -> dict:
        """The fields of a dataset's record that the settings give."""
        return {
            "id": self.id, "corpus": self.corpus, "model": {"id": self.model, "revision": self.revision}, "name_ka": self.name_ka or self.id, "name_en": self.name_en or self.id,
            "prompt": self.template, "layer": self.layer, "N": self.contexts, "per_article_cap": self.per_article, "window_tokens": self.window_tokens,
            "seeds": {"sample": self.sample_seed, "umap": self.umap.get("seed")}, "dim128_method": self.reduce, "umap": self.umap,
            "aligned_group": self.aligned_group, "reference": self.reference == self.id,
        }


# The keys of configurations, by their section, and what they are called here.
KEYS = {
    "": {"id": "id", "corpus": "corpus", "name_ka": "name_ka", "name_en": "name_en"},
    "model": {"id": "model", "revision": "revision"},
    "extract": {"min_words": "min_words", "max_words": "max_words", "min_georgian_ratio": "min_ratio", "abbrev_blocklist": "abbreviations", "group_by": "group_by"},
    "vocab": {"min_occ": "min_occurrences", "min_freq": "least_frequency", "target_size": "target", "aff": "affixes", "lemma_sources": "lemma_sources", "blocklist": "blocklist", "stopwords": "stopwords"},
    "embed": {"N": "contexts", "per_article_cap": "per_article", "seed": "sample_seed", "prompt_template": "template", "layer_frac": "layer", "layer": "layer", "window_tokens": "window_tokens"},
    "reduce": {"dim128_method": "reduce", "umap": "umap", "aligned_group": "aligned_group", "reference": "reference"},
    "neighbors": {"k": "neighbours"},
}


def build_sentences(documents: DataFrame, s: Settings = Settings(), alphabet: Alphabet = GEORGIAN, limit: int | None = None, article: str = "title") -> DataFrame:
    """``id``, ``article``, ``text``: kept sentences, each once, in the order of documents; ``limit`` takes the first documents that have a sentence."""
    kept = corpus.kept_sentences(documents, alphabet=alphabet, min_words=s.min_words, max_words=s.max_words, min_ratio=s.min_ratio)
    if limit is not None:
        first = kept.select("doc_id").distinct().orderBy("doc_id").limit(limit)
        kept = kept.join(first, "doc_id")
    once = corpus.first_of(kept, "sentence", ["doc_id", "sent_ix"])
    named = corpus.dense_ids(once, ["doc_id", "sent_ix"]).join(documents.select("doc_id", F.col(article).alias("article")), "doc_id", "left")
    return named.select("id", "article", F.col("sentence").alias("text"))


def archive_documents(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """``doc_id``, ``text``, ``title`` of the pages of an archive (``page_id``, ``title``, ``html``): each paragraph is a text of its own. ``limit`` takes the first pages."""
    if limit is not None:
        pages = pages.orderBy("page_id").limit(limit)
    paragraphs = corpus.page_paragraphs(pages).join(pages.select("page_id", "title"), "page_id")
    return corpus.dense_ids(paragraphs, ["page_id", "para_ix"], "doc_id", "paragraphs").select("doc_id", "text", "title")


def dump_documents(pages: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``title`` of the articles of a dump (``id``, ``title``, ``text``), without their markup."""
    good = pages.where(X.real_page(F.col("title"), F.col("text")))
    return good.select(F.col("id").cast("long").alias("doc_id"), X.remove_markup(F.col("text")).alias("text"), "title")


def verse_corpus(lines: DataFrame, s: Settings = Settings(), limit: int | None = None) -> DataFrame:
    """``id``, ``article``, ``text``: the groups of verse as sentences, numbered in their order; ``limit`` takes the first ones."""
    groups = corpus.verse_sentences(lines, keys=s.group_by, alphabet=s.alphabet, min_ratio=s.min_ratio)
    numbered = corpus.dense_ids(groups, ["first_line"], "id", "groups").select("id", "article", "text")
    return numbered if limit is None else numbered.where(F.col("id") < limit)


def build_forms(stems: DataFrame, affixes: morph.Affixes, lemmas: DataFrame | None = None, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    return vocab.form_to_lemma(morph.form_lemma_pairs(morph.expand(stems, affixes), lemmas, alphabet))


def build_vocabulary(sentences: DataFrame, forms: DataFrame | None = None, words: DataFrame | None = None, s: Settings = Settings(), alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """A vocabulary with up to 400 occurrences of each word; its labels are the most common of the sampled forms."""
    occ = settle(vocab.lemmatize(vocab.occurrences(sentences, alphabet=alphabet), forms), "occurrences")
    sampled = settle(vocab.capped_occurrences(occ), "sampled")
    chosen = vocab.select_vocabulary(vocab.token_frequency(occ, "lemma"), vocab.dominant_form(sampled), words, s.min_occurrences, s.target, alphabet)
    lists = sampled.groupBy("lemma").agg(F.array_sort(F.collect_list(F.struct("sid", "pos", "form"))).alias("l"))
    lists = lists.select("lemma", F.transform("l", lambda x: F.struct(x["sid"].alias("sid"), x["form"].alias("form"))).alias("occ"))
    return chosen.join(lists, "lemma").select("i", "word", "lemma", "freq", "occ")


def build_vectors(vocabulary: DataFrame, sentences: DataFrame, encoder: contexts.Encoder, dimensions: int, s: Settings = Settings(), alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``i``, ``vec``; a word of which no context can be used has a zero vector."""
    occ = vocabulary.select("i", F.posexplode("occ").alias("pos", "o")).select("i", "pos", "o.sid", "o.form")
    sampled = vocab.sample_contexts(vocab.with_context(occ, sentences), s.per_article, s.contexts, s.sample_seed)
    made = contexts.embed(contexts.inputs(sampled, s.template, alphabet=alphabet), encoder, dimensions)
    zero = F.array_repeat(F.lit(0.0), dimensions)
    return vocabulary.select("i").join(made.select("i", "vec"), "i", "left").withColumn("vec", F.coalesce("vec", zero))


def reduce_vectors(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    if s.reduce not in ("mrl", "pca"):
        raise ValueError(f"no way to reduce is called {s.reduce}")
    return layout.pca_reduce(vectors, s.dimensions) if s.reduce == "pca" else vectors.select("i", V.prefix_reduce(F.col("vec"), s.dimensions).alias("vec"))


def publish(folder: str, config: dict, vocabulary: DataFrame, vectors: DataFrame, reference: tuple[DataFrame, DataFrame, DataFrame] | None = None, laid: tuple | None = None) -> dict:
    """Neighbours in full dimension, reduced and quantised vectors, layout, files; returns the dataset's record.

    ``reference`` is the raw layout, the points and the box of the dataset that this one is aligned to; ``laid`` the layout, if it is made already."""
    s = Settings.of(config)
    v = settle(vectors, "vectors")
    failures = quality.gate(quality.equal_counts(vocabulary, v), quality.at_most(vocabulary), quality.finite(v, "vec")).collect()
    if failures:
        raise ValueError(f"not fit to be published: {failures[:5]}")
    near = settle(neighbours.exact_neighbours(v, s.neighbours), "neighbours")
    quantized = reduce_vectors(v, s).select("i", V.quantize_i8(F.col("vec")).alias("quantized"))
    _, points, _, moved = laid or layout.aligned_layout(v, *(reference or ()), **s.umap)
    shift = moved.first() if moved is not None else None
    count, width = v.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    reduced = quantized.agg(F.max(F.size("quantized.q"))).first()[0]
    moved_by = {"median": shift and shift["median"], "p95": shift and shift["p95"]}
    meta = sinks.record(**s.described(), vocab_hash=vocab.vocabulary_hash(vocabulary).first()[0], config_hash=sinks.config_hash(config), count=count, dims_full=width, dims_i8=reduced, displacement=moved_by)
    return meta | {"files": sinks.write_dataset(folder, meta, vocabulary, points, near, quantized)}


def emoji_vectors(keywords: DataFrame, vocabulary: DataFrame, reduced: DataFrame, least: float = 0.5) -> DataFrame:
    """``i``, ``emoji``, ``vec``, ``freq``: the placed emoji as a dataset of their own, numbered in their order; too few placed raise an error."""
    named = vocabulary.withColumn("word", X.nfc("word"))
    k = keywords.withColumn("keyword", X.nfc("keyword"))
    placed = settle(emoji.compose(emoji.match_words(k, named), reduced, vocabulary), "emoji")
    part = emoji.coverage(placed, keywords, least=least).first()
    if not part["enough"]:
        raise ValueError(f"only {part['placed']} of {part['asked']} emoji have words")
    return corpus.dense_ids(placed, ["emoji"], "i", "emoji")


def publish_emoji(folder: str, config: dict, keywords: DataFrame, vocabulary: DataFrame, reduced: DataFrame, least: float = 0.5, shown: int = 3) -> dict:
    """The placed emoji as a dataset of their own, with the first keywords of each in a file beside it.

    Their labels are hashed without a separator, and the old mark of an overlay is taken from all other records."""
    placed = settle(emoji_vectors(keywords, vocabulary, reduced, least), "placed")
    labels = placed.select(F.col("i").cast("int").alias("i"), F.col("emoji").alias("word"), F.col("emoji").alias("lemma"), "freq")
    meta = publish(folder, config, labels, placed.select("i", "vec"))
    first = keywords.where(F.col("rank") < shown).groupBy("emoji").agg(F.array_sort(F.collect_set(F.struct("rank", "keyword"))).alias("k"))
    rows = placed.select("i", "emoji").join(first, "emoji").select("i", F.transform("k", lambda x: x["keyword"]).alias("k")).orderBy("i").collect()  # at most 65,535
    meta |= {"emoji": True, "vocab_hash": vocab.vocabulary_hash(labels, "").first()[0]}
    sinks.write_json(f"{folder}/{meta['id']}/emoji-kw.json", [r["k"] for r in rows])
    sinks.write_json(f"{folder}/{meta['id']}/meta.json", {k: v for k, v in meta.items() if k != "files"})
    sinks.put_into_index(keywords.sparkSession, folder, meta, meta["files"], emoji=True)
    return meta


def evaluate(spark: SparkSession, folder: str, datasets: list[dict], probes: dict[str, DataFrame], words: DataFrame | None = None, least: dict[str, float] | float = 0.7) -> DataFrame:
    """``check``, ``detail`` of all that is wrong with the datasets of a folder.

    ``words`` are those that no label may be; ``least`` is the least hit rate of probes, of each corpus or of all (0.7 where none is given)."""
    from ..sources import binary, readers

    checks = [quality.total_size(sinks.files_table(spark, folder))]
    table = spark.createDataFrame([(d["id"], d["aligned_group"], bool(d["reference"]), d["displacement"]["median"], d["vocab_hash"]) for d in datasets], "id string, aligned_group string, reference boolean, median double, vocab_hash string")
    checks += [quality.displacement_below(table), quality.one_hash_per_group(table)]
    for d in datasets:
        at, n = f"{folder}/{d['id']}", d["count"]
        names = readers.labels(spark, f"{at}/labels.tsv")
        checks += [quality.count_is(names, n), quality.file_sizes(sinks.files_table(spark, at), {"points.f32": 8 * n, "vectors.i8": d["dims_i8"] * n, "vscales.f32": 4 * n})]
        checks += [quality.finite(binary.read_packed(spark, f"{at}/{f}", k, n), *c) for f, k, c in (("points.f32", "points", ("x", "y")), ("vscales.f32", "vscales", ("scale",)))]
        records = binary.read_packed(spark, f"{at}/neighbors.bin", "neighbors", n)
        checks.append(quality.count_is(records, n, "neighbour_records"))
        near = records.select("i", F.posexplode("idx").alias("rank", "j"))
        checks.append(quality.neighbours_in_range(near, n))
        if words is not None:
            checks.append(quality.no_listed_words(names, words))
        if d.get("corpus") in probes:
            checks.append(quality.probes_pass(evaluation.probe_metrics(probes[d["corpus"]], names, near), least.get(d["corpus"], 0.7) if isinstance(least, dict) else least))
    return quality.gate(*checks)
