"""Evaluation of vector sets: analogies, related terms, probes, and training sweeps of word vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Word2Vec
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.alphabet import GEORGIAN, Alphabet
from ..runtime import settle

#: Stated queries that are sent to all tasks at once.
QUERIES_AT_ONCE = 4096


def units(vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """``word`` and ``u``, the vector at length 1."""
    return vectors.select(F.col(word).alias("word"), V.l2_normalize(F.col(vec)).alias("u"))


def ranked_targets(queries: DataFrame, u: DataFrame, exclude: list[str]) -> DataFrame:
    """All words by similarity to each query's ``target`` vector, ranked from 0; the words in ``exclude`` columns are left out.

    The stated queries are sent to the vectors, which are read once and never moved, in parts of at most ``QUERIES_AT_ONCE``; an index
    holds at most 65,535 words, so that is all that meets."""
    number = queries.count()
    if number > QUERIES_AT_ONCE:
        parts = -(-number // QUERIES_AT_ONCE)
        cut = settle(queries.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.lit(parts))), "queries")
        return reduce(DataFrame.unionByName, (_scored(cut.where(F.col("__part") == n).drop("__part"), u, exclude) for n in range(parts)))
    return _scored(queries, u, exclude)


def _scored(queries: DataFrame, u: DataFrame, exclude: list[str]) -> DataFrame:
    scored = u.crossJoin(F.broadcast(queries)).select(*queries.columns, F.col("word").alias("candidate"), F.round(V.dot(F.col("target"), F.col("u")), 9).alias("score"))
    for c in exclude:
        scored = scored.where(F.col("candidate") != F.col(c))
    return scored


def analogies(queries: DataFrame, vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """The ``target`` of each query (``a``, ``b``, ``c``, further columns): b + c - a on vectors of length 1. Queries with unknown words are dropped."""
    u = units(vectors, word, vec)
    q = queries
    for c in "abc":
        q = q.join(u.select(F.col("word").alias(c), F.col("u").alias(f"u{c}")), c)
    return q.withColumn("target", V.l2_normalize(V.combine([(1.0, F.col("ub")), (1.0, F.col("uc")), (-1.0, F.col("ua"))]))).select(*queries.columns, "target")


def analogy_topk(queries: DataFrame, vectors: DataFrame, k: int = 10, word: str = "word", vec: str = "vec") -> DataFrame:
    """``a``, ``b``, ``c``, ``rank`` (from 0), ``candidate``, ``score``: the k most similar words of each analogy, its own words left out."""
    q = analogies(queries.select("a", "b", "c").distinct(), vectors, word, vec)
    scored = ranked_targets(q, units(vectors, word, vec), ["a", "b", "c"])
    w = Window.partitionBy("a", "b", "c").orderBy(F.desc("score"), "candidate")
    return scored.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < k).select("a", "b", "c", "rank", "candidate", "score")


def analogy_rank(queries: DataFrame, vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """``a``, ``b``, ``c``, ``d``, ``rank``: the place of d among all words but a, b and c, from 0; -1 if a word is unknown or d one of them.

    The rank is a count of the words that come before d, so nothing is sorted."""
    asked = queries.select("a", "b", "c", "d").distinct()
    u = units(vectors, word, vec)
    q = analogies(asked, vectors, word, vec).join(u.select(F.col("word").alias("d"), F.col("u").alias("ud")), "d")
    q = q.where("d NOT IN (a, b, c)").select("a", "b", "c", "d", "target", F.round(V.dot(F.col("target"), F.col("ud")), 9).alias("own"))
    scored = ranked_targets(q, u, ["a", "b", "c"])
    before = (F.col("score") > F.col("own")) | ((F.col("score") == F.col("own")) & (F.col("candidate") < F.col("d")))
    ranks = scored.groupBy("a", "b", "c", "d").agg(F.count_if(before).alias("rank"))
    return asked.join(ranks, ["a", "b", "c", "d"], "left").withColumn("rank", F.coalesce("rank", F.lit(-1)))


def analogy_evaluation(queries: DataFrame, vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """``score``: 1 - mean rank / vocabulary over both directions of each analogy."""
    both = queries.select("a", "b", "c", "d").unionByName(queries.select(F.col("c").alias("a"), F.col("d").alias("b"), F.col("a").alias("c"), F.col("b").alias("d")))
    size = vectors.agg(F.count_distinct(word).alias("n"))
    return analogy_rank(both, vectors, word, vec).agg(F.avg("rank").alias("m")).crossJoin(size).select(F.round(1 - F.col("m") / F.col("n"), 4).alias("score"))


def analogy_accuracy(questions: DataFrame, vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """One row: ``asked``, ``known`` (all four words are), ``right`` (d comes first), ``accuracy`` of the known ones, 0 if there are none."""
    r = analogy_rank(questions, vectors, word, vec)
    n = r.agg(F.count(F.lit(1)).alias("asked"), F.count_if(F.col("rank") >= 0).alias("known"), F.count_if(F.col("rank") == 0).alias("right"))
    return n.withColumn("accuracy", F.when(F.col("known") > 0, F.col("right") / F.col("known")).otherwise(F.lit(0.0)))


def related_ranks(related: DataFrame, vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """``subject``, ``term``, ``rank``: the place of each related term among all words but the subject, from 0; -1 if either is unknown."""
    u = units(vectors, word, vec)
    asked = related.select("subject", "term").distinct()
    q = asked.select("subject").distinct().join(u.select(F.col("word").alias("subject"), F.col("u").alias("target")), "subject")
    w = Window.partitionBy("subject").orderBy(F.desc("score"), "candidate")  # of at most 65,535 words for each stated subject
    ranks = ranked_targets(q, u, ["subject"]).select("subject", F.col("candidate").alias("term"), (F.row_number().over(w) - 1).alias("rank"))
    return asked.join(ranks, ["subject", "term"], "left").withColumn("rank", F.coalesce("rank", F.lit(-1)))


def related_evaluation(related: DataFrame, vectors: DataFrame, word: str = "word", vec: str = "vec") -> DataFrame:
    """``score``: the mean over subjects of 1 - mean rank / vocabulary."""
    size = vectors.agg(F.count_distinct(word).alias("n"))
    each = related_ranks(related, vectors, word, vec).groupBy("subject").agg(F.avg("rank").alias("m")).crossJoin(size)
    return each.agg(F.avg(F.round(1 - F.col("m") / F.col("n"), 4)).alias("score"))


def evaluate(analogy: DataFrame, related: DataFrame) -> DataFrame:
    """``analogy``, ``related``, ``score``: both scores and their mean."""
    return analogy.select(F.col("score").alias("analogy")).crossJoin(related.select(F.col("score").alias("related"))).select("analogy", "related", ((F.col("analogy") + F.col("related")) / 2).alias("score"))


def probe_metrics(probes: DataFrame, vocab: DataFrame, neighbours: DataFrame, alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """One row: ``probes``, ``present``, ``hits``, ``forbidden``, ``hit_rate`` (0 if none is present).

    ``probes`` has word, expected and forbidden (lists); a probe is present if a vocabulary row has its root, the first such row
    stands for it, and it hits if one of the expected roots is among its neighbours' roots."""
    roots = vocab.select("i", X.stem(F.col("word"), alphabet).alias("root")).where("root IS NOT NULL")
    first = roots.groupBy("root").agg(F.min("i").alias("i"))
    near = neighbours.select(F.col("i").alias("of"), "j").join(roots.select(F.col("i").alias("j"), "root"), "j")
    p = probes.select(F.monotonically_increasing_id().alias("p"), X.stem(F.col("word"), alphabet).alias("root"), *(F.transform(c, lambda w: X.stem(w, alphabet)).alias(c) for c in ("expected", "forbidden")))
    placed = p.join(first, "root", "left")
    found = placed.join(near.select(F.col("of").alias("i"), F.col("root").alias("near_root")), "i", "left")
    each = found.groupBy("p").agg(
        F.max(F.col("i").isNotNull().cast("int")).alias("present"),
        F.max(F.coalesce(F.expr("array_contains(expected, near_root)").cast("int"), F.lit(0))).alias("hit"),
        F.max(F.coalesce(F.expr("array_contains(forbidden, near_root)").cast("int"), F.lit(0))).alias("bad"),
    )
    total = each.agg(F.count(F.lit(1)).alias("probes"), F.coalesce(F.sum("present"), F.lit(0)).alias("present"), F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"), F.coalesce(F.sum("bad"), F.lit(0)).alias("forbidden"))
    return total.withColumn("hit_rate", F.when(F.col("present") > 0, F.col("hits") / F.col("present")).otherwise(F.lit(0.0)))


def train_word_vectors(corpus: DataFrame, tokens_col: str = "tokens", size: int = 100, window: int = 5, rate: float = 0.025, iterations: int = 1, max_vocab: int | None = 20_000, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``word``, ``vec``: skip-gram vectors; the vocabulary is cut to the most frequent words before.

    The corpus is trained on in ``partitions`` parts side by side, whose vectors are put together after each iteration: as many as
    there are cores unless said otherwise. With more parts than one, results depend on their number."""
    if max_vocab is not None:
        counts = corpus.select(F.explode(tokens_col).alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(max_vocab)
        kept = corpus.select(F.monotonically_increasing_id().alias("r"), F.posexplode(tokens_col).alias("p", "w")).join(counts, "w")
        corpus = kept.groupBy("r").agg(F.array_sort(F.collect_list(F.struct("p", "w"))).alias("l")).select(F.transform("l", lambda x: x["w"]).alias(tokens_col))
    from pyspark.ml.functions import vector_to_array

    parts = partitions or corpus.sparkSession.sparkContext.defaultParallelism
    model = Word2Vec(vectorSize=size, windowSize=window, stepSize=rate, maxIter=iterations, numPartitions=parts, minCount=0, seed=seed, inputCol=tokens_col, outputCol="out").fit(corpus)
    return model.getVectors().select("word", vector_to_array("vector").alias("vec"))


def sweep(corpus: DataFrame, analogy: DataFrame, related: DataFrame, grid: list[dict], patience: int | None = None, tokens_col: str = "tokens") -> list[dict]:
    """Train and score each setting of a grid, the best first; stops after ``patience`` settings without a better score."""
    out, best, since = [], float("-inf"), 0
    for setting in grid:
        v = train_word_vectors(corpus, tokens_col, **setting).cache()
        score = evaluate(analogy_evaluation(analogy, v), related_evaluation(related, v)).first()["score"]
        v.unpersist()
        out.append(setting | {"score": score})
        best, since = (score, 0) if score is not None and score > best else (best, since + 1)
        if patience is not None and since >= patience:
            break
    return sorted(out, key=lambda r: -(r["score"] or 0))


def best_trials(trials: DataFrame, value: str = "value", number: int = 200) -> DataFrame:
    """The trials with the highest values, a null value counting as 0."""
    return trials.orderBy(F.coalesce(value, F.lit(0)).desc(), *[c for c in trials.columns if c != value]).limit(number)
