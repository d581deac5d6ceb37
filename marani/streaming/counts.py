"""A streaming slice: sentences arrive, repeated ones are dropped, tokens are counted."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.alphabet import GEORGIAN, Alphabet
from ..runtime import own_dir


def distinct_sentences(stream: DataFrame, time_col: str | None = None, lateness: str = "7 days", text_col: str = "text") -> DataFrame:
    """Sentences that weren't there before; with a time column the memory of them ends with the watermark, so state is bounded."""
    if time_col is None:
        return stream.dropDuplicates([text_col])
    return stream.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark([text_col])


def token_counts(stream: DataFrame, text_col: str = "text", alphabet: Alphabet = GEORGIAN) -> DataFrame:
    """``token``, ``freq``, for output mode complete or update."""
    token = F.explode(F.transform(X.tokens(F.col(text_col), alphabet), X.fold)).alias("token")
    return stream.select(token).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))


def windowed_counts(stream: DataFrame, time_col: str, key: str, width: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Rows of each key in each window of time; late rows count as long as the watermark allows."""
    late = stream.withWatermark(time_col, lateness)
    return late.groupBy(F.window(time_col, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def run_to_end(result: DataFrame, label: str) -> DataFrame:
    """Run a stream over all that has arrived, in batches, and read its last complete result, which each batch writes anew."""
    spark = result.sparkSession
    base = f"{own_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    run = result.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/out")
