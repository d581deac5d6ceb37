from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from marani.operators import membership


def test_filter(spark):
    words = [f"სიტყვა {n}" for n in range(5000)]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string").repartition(3)
    f = membership.filter_of(df.where("w is not null").select(F.xxhash64("w")), len(words))
    own = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in words], np.uint64)
    assert f.may_hold(own).all() and all(f.may_hold_one(int(x)) for x in own[:50])
    others = np.array([xxhash.xxh64_intdigest(f"x{n}".encode(), 42) for n in range(5000)], np.uint64)
    assert f.may_hold(others).mean() < 0.1
    empty = membership.filter_of(df.where("w is null").select(F.xxhash64("w").alias("h")).limit(0), 0)
    assert not empty.may_hold(own).any()
