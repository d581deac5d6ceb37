"""Vocabulary operators: occurrences, frequencies, capped samples, selection, hashing, collapsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.alphabet import GEORGIAN, Alphabet
from ..runtime import spread
from .corpus import dense_ids

SEED, OCCURRENCES, CEILING = 20260704, 400, 65_535


def occurrences(sentences: DataFrame, id_col: str = "id", text_col: str = "text", alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``sid``, ``pos``, ``form``: every run of the alphabet's letters in every text, folded."""
    return sentences.select(F.col(id_col).alias("sid"), F.posexplode(X.tokens(F.col(text_col), alphabet)).alias("pos", "form")).withColumn("form", X.fold(F.col("form")))


def form_to_lemma(pairs: DataFrame) -> DataFrame:
    """``form``, ``lemma``: forms that have just one lemma; a form with several is dropped, its identity included."""
    once = pairs.select("form", "lemma").where("form IS NOT NULL AND lemma IS NOT NULL").distinct()  # hashed, and few rows are left to sort
    return once.groupBy("form").agg(F.min("lemma").alias("lemma"), F.count(F.lit(1)).alias("__n")).where("__n = 1").drop("__n")


def lemmatize(occ: DataFrame, forms: DataFrame | None) -> DataFrame:
    """Occurrences with their lemma; those of unknown forms are dropped. Without a map every form is its own lemma."""
    return occ.withColumn("lemma", F.col("form")) if forms is None else occ.join(forms, "form")


def token_frequency(occ: DataFrame, key: str = "form") -> DataFrame:
    return occ.groupBy(key).agg(F.count(F.lit(1)).alias("freq"))


def draw_key(seed: int, *cols: str) -> Column:
    """A random key that a row keeps wherever it is processed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in cols)))


def capped_occurrences(occ: DataFrame, cap: int = OCCURRENCES, seed: int = SEED) -> DataFrame:
    """At most ``cap`` occurrences of each lemma, each equally likely: those with the smallest random keys.

    The rank filter is pushed below the shuffle, so that of a frequent lemma each task sends no more than the cap."""
    w = Window.partitionBy("lemma").orderBy(draw_key(seed, "lemma", "sid", "pos"), "sid", "pos")
    return occ.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= cap).drop("__r")


def dominant_form(occ: DataFrame) -> DataFrame:
    """``lemma``, ``word``: the most common form of each lemma, of equally common ones the one that comes first."""
    counts = occ.groupBy("lemma", "form").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("sid", "pos")).alias("first"))
    return counts.groupBy("lemma").agg(F.min_by("form", F.struct(-F.col("n"), F.col("first"), F.col("form"))).alias("word"))


def without_words(df: DataFrame, words: DataFrame, *cols: str) -> DataFrame:
    """Rows of which none of the columns is one of the words."""
    folded = words.select(X.fold(F.col(words.columns[0])).alias("__word")).distinct()
    for c in cols:
        df = df.join(folded, F.col(c) == F.col("__word"), "left_anti")
    return df


def select_vocabulary(freq: DataFrame, labels: DataFrame, words: DataFrame | None = None, least: int = 8, target: int = 30_000, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``i``, ``word``, ``lemma``, ``freq``: lemmas that are frequent enough and, with their label, words of two letters or more
    and not in the list; the most frequent ``target``, numbered in that order. More than 65,535 can't be numbered and raise an error."""
    if target > CEILING:
        raise ValueError(f"neighbour records number at most {CEILING} words")
    joined = freq.where(F.col("freq") >= least).join(labels, "lemma", "left").withColumn("word", F.coalesce("word", "lemma"))
    good = joined
    for c in ("lemma", "word"):
        good = good.where(X.is_word(F.col(c), alphabet) & (F.length(c) >= 2))
    if words is not None:
        good = without_words(good, words, "lemma", "word")
    top = good.orderBy(F.desc("freq"), "lemma").limit(target)
    # At most 65,535 rows are left, so numbering them in one task is bounded.
    return top.select((F.row_number().over(Window.orderBy(F.desc("freq"), "lemma")) - 1).alias("i"), "word", "lemma", "freq")


def vocabulary_hash(vocab: DataFrame, separator: str = "\n", order: str = "i", label: str = "word") -> DataFrame:
    """``vocab_hash``: SHA-256 of all labels in the order of their index; of at most 65,535 labels."""
    listed = F.array_sort(F.collect_list(F.struct(order, label)))
    return vocab.agg(F.sha2(F.array_join(F.transform(listed, lambda x: x[label]), separator), 256).alias("vocab_hash"))


def collapse(vocab: DataFrame, cap: int = OCCURRENCES, target: int | None = None, seed: int = SEED, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``i``, ``word``, ``lemma``, ``freq``, ``occ``, ``src_i``: one row for each root.

    The most frequent word stands for its root, of equal ones the smaller; frequencies add up; occurrences are put together in
    the members' order and, beyond ``cap``, sampled by random keys. ``src_i`` is the old index of the row that stands. Thresholds and lists aren't applied again."""
    rows = vocab.select("i", "word", F.coalesce("freq", F.lit(0)).alias("freq"), F.coalesce("occ", F.array().cast(vocab.schema["occ"].dataType)).alias("occ"), X.stem(F.col("word"), alphabet).alias("lemma")).where("word IS NOT NULL")
    order = F.struct((-F.col("freq")).alias("f"), F.col("word").alias("w"), F.col("i").alias("i"))
    roots = rows.groupBy("lemma").agg(F.min(order).alias("first"), F.sum("freq").alias("freq"))
    occ = rows.select("lemma", order.alias("o"), F.posexplode("occ").alias("pos", "x"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "lemma", F.col("o.w"), F.col("o.i").cast("string"), F.col("pos").cast("string")))
    many = Window.partitionBy("lemma")
    sampled = (
        occ.withColumn("__r", F.row_number().over(many.orderBy(key, "o", "pos")))
        .where(F.col("__r") <= cap)
        .groupBy("lemma")
        .agg(F.array_sort(F.collect_list(F.struct("o", "pos", "x"))).alias("l"))
        .select("lemma", F.transform("l", lambda x: x["x"]).alias("occ"))
    )
    joined = roots.join(sampled, "lemma", "left").select(F.col("first.w").alias("word"), "lemma", "freq", F.coalesce("occ", F.array().cast(vocab.schema["occ"].dataType)).alias("occ"), F.col("first.i").alias("src_i"))
    joined = joined.withColumn("__f", -F.col("freq"))
    if target is not None:
        joined = joined.orderBy("__f", "word").limit(target)
    return dense_ids(joined, ["__f", "word", "src_i"], "i", "roots").drop("__f").select("i", "word", "lemma", "freq", "occ", "src_i")


def with_context(occ: DataFrame, sentences: DataFrame) -> DataFrame:
    """Occurrences with ``article`` and ``text`` of their sentence, empty where there is no such sentence."""
    s = sentences.select(F.col("id").alias("sid"), "article", "text")
    return spread(occ).join(s, "sid", "left").withColumns({"article": F.coalesce("article", F.lit("")), "text": F.coalesce("text", F.lit(""))})


def sample_contexts(occ: DataFrame, per_article: int = 2, size: int = 64, seed: int = SEED, key: str = "i") -> DataFrame:
    """At most ``size`` occurrences of each word and ``per_article`` of any article, taken greedily in a random order.

    Two ranks by one key do the same as the greedy loop: the rank within the article is cut first, then the rank within the word."""
    draw = draw_key(seed, key, "sid", "pos")
    own = Window.partitionBy(key, "article").orderBy("__k", "sid", "pos")
    all_ = Window.partitionBy(key).orderBy("__k", "sid", "pos")
    capped = occ.withColumn("__k", draw).withColumn("__r", F.row_number().over(own)).where(F.col("__r") <= per_article)
    return capped.withColumn("__n", F.row_number().over(all_)).where(F.col("__n") <= size).drop("__k", "__r", "__n")


def wordcount(groups: DataFrame, tokens_col: str) -> DataFrame:
    """``word``, ``count``, ``len``."""
    return groups.select(F.explode(tokens_col).alias("word")).groupBy("word").count().withColumn("len", F.length("word"))


def wordcount_stats(groups: DataFrame, tokens_col: str) -> DataFrame:
    """One row of the numbers of groups and words and the longest and shortest of them."""
    sizes = groups.select(F.size(tokens_col).alias("n"), F.transform(tokens_col, F.length).alias("l"))
    of_groups = sizes.agg(
        F.max("n").alias("max_group_length"),
        F.max(F.array_max("l")).alias("max_word_length"),
        F.min(F.array_min("l")).alias("min_word_length"),
        F.sum("n").alias("total_words"),
        F.count(F.lit(1)).alias("total_groups"),
    )
    unique = wordcount(groups, tokens_col).agg(F.count(F.lit(1)).alias("total_unique_words"))
    return of_groups.crossJoin(unique)  # of one row each
