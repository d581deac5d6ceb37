"""Vectors of emoji, put together from the words that their keywords match."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..functions.alphabet import SPACE

DECAY, TOKEN_PART = 0.65, 0.5


def plain_keywords(field: Column) -> Column:
    """The keywords between ``|``, trimmed, without empty ones."""
    return F.coalesce(F.filter(F.transform(F.split(field, r"\|"), lambda k: X.strip(k)), lambda k: k != ""), F.array().cast("array<string>"))


def match_words(keywords: DataFrame, vocab: DataFrame, key: str = "emoji") -> DataFrame:
    """``key``, ``i``, ``weight``: the vocabulary words of each emoji.

    A keyword (``rank`` from 0) that is a word counts 0.65 to the power of its rank; of one that isn't, each of its tokens that is a
    word counts half of that. A word that several keywords match has the largest weight, and doubled words their first row."""
    words = vocab.where("word IS NOT NULL").groupBy("word").agg(F.min("i").alias("i"))
    base = keywords.select(key, "keyword", F.pow(F.lit(DECAY), F.col("rank")).alias("base"))
    whole = base.join(words, F.col("keyword") == F.col("word"), "left")
    direct = whole.where("i IS NOT NULL").select(key, "i", F.col("base").alias("weight"))
    token = F.explode(F.filter(F.split("keyword", f"{SPACE}+"), lambda t: t != "")).alias("token")
    parts = whole.where("i IS NULL").select(key, "base", token).join(words, F.col("token") == F.col("word")).select(key, "i", (F.col("base") * TOKEN_PART).alias("weight"))
    return direct.unionByName(parts).groupBy(key, "i").agg(F.max("weight").alias("weight"))


def compose(matches: DataFrame, vectors: DataFrame, vocab: DataFrame, key: str = "emoji", vec: str = "vec") -> DataFrame:
    """``key``, ``vec``, ``freq``: the weighted mean of the matched words' vectors at length 1 and their highest frequency.

    An emoji that matches no word with a vector, or whose mean is zero, isn't placed."""
    joined = matches.join(vectors.select("i", F.col(vec).alias("v")), "i").join(vocab.select("i", F.coalesce("freq", F.lit(0)).alias("f")), "i", "left")
    whole_vector = array_to_vector(F.col("v").cast("array<double>"))
    mean = joined.groupBy(key).agg(Summarizer.mean(whole_vector, F.col("weight")).alias("m"), F.max("f").alias("freq"))
    whole = mean.select(key, vector_to_array("m").alias("v"), "freq")
    return whole.where(V.norm(F.col("v")) > 0).select(key, V.l2_normalize(F.col("v")).alias("vec"), "freq")


def coverage(placed: DataFrame, asked: DataFrame, key: str = "emoji", least: float = 0.5) -> DataFrame:
    """One row: ``asked``, ``placed``, ``part``, ``enough``."""
    a, p = asked.agg(F.count_distinct(key).alias("asked")), placed.agg(F.count_distinct(key).alias("placed"))
    part = F.when(F.col("asked") > 0, F.col("placed") / F.col("asked")).otherwise(F.lit(0.0))
    return a.crossJoin(p).withColumn("part", part).withColumn("enough", F.col("part") >= least)
