"""Exact nearest neighbours by blocks of matrix products, and the packed records that publish them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..runtime import settle

BLOCK_ROWS = 4096
#: Bytes of an index that is sent to all executors; larger ones are compared in a grid of blocks.
SENT_BYTES = 64 << 20
#: The least and the largest index of a packed record by its bytes.
INDEXES = {2: (0, 65535), 4: (-(1 << 31), (1 << 31) - 1)}


def _unit(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    m = V.matrix_of(column)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


def _best(ids: np.ndarray, a: np.ndarray, others: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (i, j, cosine) of the k best of each row of a; equal cosines by the smaller id, whatever the block."""
    cos = np.round(a @ b.T, 12)
    cos[ids[:, None] == others[None, :]] = -9
    k = min(k, len(others))
    edge = np.partition(cos, cos.shape[1] - k, axis=1)[:, -k]
    row, col = np.nonzero((cos >= edge[:, None]) & (cos > -9))
    order = np.lexsort((others[col], -cos[row, col], row))
    row, col = row[order], col[order]
    start = np.searchsorted(row, np.arange(len(ids)))
    keep = np.arange(len(row)) - start[row] < k
    return ids[row[keep]], others[col[keep]], cos[row[keep], col[keep]]


def exact_neighbours(vectors: DataFrame, k: int = 15, id_col: str = "i", vec_col: str = "vec", sent_bytes: int = SENT_BYTES) -> DataFrame:
    """``i``, ``rank`` (from 0), ``j``, ``cos``, ``sim_u8``: the k nearest of each vector by cosine, itself left out.

    A zero vector has cosine 0 to all. With no more than k others all are taken. Ids must be unique and vectors not null and of one
    length. A small index is sent to all executors, whose tasks run through it in blocks; a larger one is cut into a grid
    of blocks that are compared pair by pair, of which each task holds two."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("i"), F.col(vec_col).alias("v")).where("i IS NOT NULL AND v IS NOT NULL")
    count, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    schema = "i long, j long, cos double"
    if count * (width or 0) * 8 <= sent_bytes:
        table = rows.orderBy("i").toArrow()
        sent = spark.sparkContext.broadcast((np.asarray(table.column("i")), _unit(table.column("v")) if count else np.zeros((0, 0))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            others, b = sent.value
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    part = whole.slice(at, 1024)
                    ids, a = np.asarray(part.column(0)), _unit(part.column(1))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in _best(ids, a, others, b, k)], names=["i", "j", "cos"])

        found = rows.mapInArrow(run, schema)
    else:
        blocks = -(-count // BLOCK_ROWS)
        cut = settle(rows.withColumn("b", F.pmod(F.xxhash64("i"), F.lit(blocks)).cast("int")), "blocks")
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        left = cut.select(F.col("b").alias("row"), every.alias("col"), F.lit(True).alias("asks"), "i", "v")
        right = cut.select(every.alias("row"), F.col("b").alias("col"), F.lit(False).alias("asks"), "i", "v")

        def compare(block: pa.Table) -> pa.Table:
            asks = np.asarray(block.column("asks"))
            if asks.all() or not asks.any():
                return pa.table({"i": pa.array([], pa.int64()), "j": pa.array([], pa.int64()), "cos": pa.array([], pa.float64())})
            ids, v = np.asarray(block.column("i")), _unit(block.column("v"))
            i, j, cos = _best(ids[asks], v[asks], ids[~asks], v[~asks], k)
            return pa.table({"i": i, "j": j, "cos": cos})

        partial = left.unionByName(right).groupBy("row", "col").applyInArrow(compare, schema)
        w = Window.partitionBy("i").orderBy(F.desc("cos"), "j")
        found = partial.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
    w = Window.partitionBy("i").orderBy(F.desc("cos"), "j")
    return found.select("i", (F.row_number().over(w) - 1).alias("rank"), "j", "cos", V.cosine_u8(F.col("cos")).alias("sim_u8"))


def index_bytes(neighbours: DataFrame) -> int:
    """The bytes that an index needs in a record: 2 where each ``j`` fits into them, as in a published dataset, else 4."""
    low, high = neighbours.agg(F.min("j"), F.max("j")).first()
    return 2 if low is None or low >= INDEXES[2][0] and high <= INDEXES[2][1] else 4


def pack_neighbours(neighbours: DataFrame, index_bytes: int = 2) -> DataFrame:
    """``i``, ``record``: the neighbours of each row as three bytes each, a little-endian 16-bit index and an 8-bit similarity.

    With 4 bytes for an index, which is signed then, larger numbers of rows are held too, by records of five bytes."""
    byte = lambda x: F.substring(F.lpad(F.hex(x.cast("long")), 2, "0"), -2, 2)
    index = [byte(F.shiftright("j", 8 * n).bitwiseAND(255)) for n in range(index_bytes)]
    least, most = INDEXES[index_bytes]
    checked = F.when((F.col("j") >= least) & (F.col("j") <= most), F.concat(*index, byte(F.col("sim_u8")))).otherwise(F.raise_error(F.lit(f"a neighbour's index doesn't fit into {8 * index_bytes} bits")))
    return neighbours.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("rank", checked.alias("h")))).alias("l")).select("i", F.unhex(F.array_join(F.transform("l", lambda x: x["h"]), "")).alias("record"))


def unpack_neighbours(records: DataFrame, index_bytes: int = 2) -> DataFrame:
    """``i``, ``rank``, ``j``, ``sim_u8`` of packed records; a record that isn't a multiple of three bytes, or of five with 4 bytes for an index, gives no row."""
    width = index_bytes + 1
    text = F.hex("record")
    each = F.transform(F.sequence(F.lit(0), (F.length("record") / width - 1).cast("int")), lambda n: F.substring(text, n * 2 * width + 1, F.lit(2 * width)))
    value = lambda n: F.conv(F.substring(F.col("h"), 2 * n + 1, 2), 16, 10).cast("int")
    index = reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(value(n), 8 * n) for n in range(index_bytes)))
    good = records.where((F.length("record") > 0) & (F.length("record") % width == 0))
    return good.select("i", F.posexplode(each).alias("rank", "h")).select("i", "rank", index.alias("j"), value(index_bytes).cast("smallint").alias("sim_u8"))
