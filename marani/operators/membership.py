"""A filter of hash values in a bounded number of bits: what isn't in it was surely not among the hashes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the largest filter, as a power of two (32 MB), and of one row in which parts of it travel.
MOST_BITS, ROW_BITS = 28, 19


@dataclass
class Filter:
    power: int
    packed: np.ndarray  # one bit for each beginning of so many bits that a hash value has

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.astype(np.uint64) >> np.uint64(64 - self.power)
        return (self.packed[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def may_hold_one(self, value: int) -> bool:
        at = (value & 0xFFFFFFFFFFFFFFFF) >> (64 - self.power)
        return bool(self.packed[at >> 3] >> (at & 7) & 1)


def filter_of(hashes: DataFrame, count: int, bits_each: int = 32) -> Filter:
    """The filter of the 64-bit values in the first column, of which there are about ``count``.

    Each task sends the parts of the filter that it sets, and parts are put together before they come to the driver, so no more
    than 2 ** MOST_BITS bits arrive. With very many values it lets more through; it never keeps one out."""
    power = min(MOST_BITS, max(ROW_BITS, math.ceil(math.log2(max(1, count) * bits_each))))
    size = 1 << (ROW_BITS - 3)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (power - 3), np.uint8)
        for b in batches:
            at = np.asarray(b.column(0).drop_null()).astype(np.int64).view(np.uint64) >> np.uint64(64 - power)
            np.bitwise_or.at(own, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
        rows = own.reshape(-1, size)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([rows[n].tobytes() for n in used], pa.binary())], names=["part", "bits"])

    def together(block: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in block.column("bits").to_pylist()])
        return pa.table({"part": block.column("part").slice(0, 1), "bits": pa.array([whole.tobytes()], pa.binary())})

    packed = np.zeros(1 << (power - 3), np.uint8).reshape(-1, size)
    schema = "part int, bits binary"
    for r in hashes.select(F.col(hashes.columns[0]).cast("long")).mapInArrow(parts, schema).groupBy("part").applyInArrow(together, schema).collect():
        packed[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return Filter(power, packed.ravel())
