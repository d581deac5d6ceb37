"""A uniform sample of fixed size from data of unknown length that arrives in pieces (problem 1): accept-waitlist sampling.

Every record gets a random key, the MD5 of a seed and of what identifies the record, so a record that is delivered again has the
same key and late ones theirs, whatever piece they come in. The sample is the records with the ``size`` smallest keys. After
counting, two bounds on the keys are known that hold with a chance of 1 - DOUBT: below the lower one, by Bernstein's inequality,
lie fewer keys than wanted, so these records are accepted outright; above the upper one none is needed. Only the waitlist
between the two, of about the square root of the sample's size, is sorted. If the bounds fail they are widened and tried again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import settle

DOUBT = 1e-4


def bounds(size: int, count: int, doubt: float) -> tuple[float, float]:
    """The keys, as parts of their range, below which a record is accepted and above which it is rejected."""
    p = size / count
    low, high = -2 * math.log(doubt) / (3 * count), -math.log(doubt) / count
    return max(0.0, p + low - math.sqrt(low * low + 3 * low * p)), min(1.0, p + high + math.sqrt(high * high + 2 * high * p))


def _hex(part: float) -> str:
    """A bound as the beginning of a hexadecimal key; above all keys where it is 1."""
    return "g" if part >= 1 else f"{int(part * (1 << 52)):013x}"


def random_key(id_cols: list[str], seed: int) -> Column:
    """32 hexadecimal digits; nulls in the identifying columns count as a value of their own."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("?")) for c in id_cols)))


def sample(df: DataFrame, size: int, id_cols: list[str], order_cols: list[str], keep: list[str], seed: int = 1, doubt: float = DOUBT) -> DataFrame:
    """``id_cols`` and ``keep`` of a uniform sample of ``size`` of the records that ``id_cols`` identify.

    Rows that repeat a record count once; the one that comes first by ``order_cols`` (then ``keep``, nulls first) stands for it.
    If there are no more than ``size`` records, all are taken. Every column may hold nulls; columns that aren't named aren't read."""
    names = list(dict.fromkeys([*id_cols, *order_cols, *keep]))
    rows = df.select(*(F.col(f"`{c}`") for c in names))
    count = rows.select(*(F.col(f"`{c}`") for c in id_cols)).distinct().count()
    first = F.min(F.struct(*(F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate([*order_cols, *keep])))).alias("first")
    out = [*(F.col(f"`{c}`") for c in id_cols), *(F.col(f"first.c{len(order_cols) + n}").alias(c) for n, c in enumerate(keep))]
    keyed = rows.withColumn("__key", random_key(id_cols, seed))
    groups = ["__key", *(f"`{c}`" for c in id_cols)]
    if count <= size:
        return keyed.groupBy(*groups).agg(first).select(*out)
    while True:
        low, high = bounds(size, count, doubt)
        near = settle(keyed.where(F.col("__key") < _hex(high)).groupBy(*groups).agg(first), "candidates")
        accepted, kept = near.agg(F.count_if(F.col("__key") < _hex(low)), F.count(F.lit(1))).first()
        if accepted <= size <= kept:
            break
        doubt = doubt * doubt  # wider bounds; they hold in the end, as they go to 0 and 1
    sure = near.where(F.col("__key") < _hex(low))
    waitlist = near.where(F.col("__key") >= _hex(low)).orderBy("__key", *(f"`{c}`" for c in id_cols)).limit(size - accepted)
    return sure.unionByName(waitlist).select(*out)
