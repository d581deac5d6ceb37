from __future__ import annotations

from marani.streaming import counts


def test_counts(spark, tmp_path):
    rows = [("ერთი ორი", "2024-01-01 00:00:00"), ("ერთი ორი", "2024-01-01 01:00:00"), ("ორი", "2024-01-02 00:00:00"), (None, None)]
    df = spark.createDataFrame(rows, "text string, at string").selectExpr("text", "timestamp(at) AS at")
    for part in (0, 1):
        df.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = counts.run_to_end(counts.token_counts(counts.distinct_sentences(stream)), "t").collect()
    assert {r["token"]: r["freq"] for r in got} == {"ერთი": 1, "ორი": 2}
    late = counts.windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "at", "text")
    assert late.isStreaming and counts.distinct_sentences(stream, "at").isStreaming
