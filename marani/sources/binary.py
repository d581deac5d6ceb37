"""The packed files of a published dataset as a data source: ``spark.read.format("marani_packed")``.

Options: ``path``, ``kind`` (neighbors, points, vectors, vscales), ``count``, for vectors ``dims``,
for neighbors ``index_bytes`` (2, or 4 for more rows than a published dataset may have). Rows are fixed-width
records, so a file is cut into ranges of rows that are read in parallel."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import files

SCHEMAS = {
    "neighbors": "i int, idx array<int>, sim array<smallint>",
    "points": "i int, x float, y float",
    "vectors": "i int, q array<tinyint>",
    "vscales": "i int, scale float",
}
RECORDS = {n: np.dtype([("idx", kind), ("sim", "u1")]) for n, kind in ((2, "<u2"), (4, "<i4"))}
ROWS = 16_384


@dataclass
class RowRange(InputPartition):
    start: int
    end: int


class PackedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.kind, self.count = options["path"], options["kind"], int(options["count"])
        size = files.size(self.path)
        if size is None:
            raise FileNotFoundError(self.path)
        if self.kind == "neighbors":
            self.record = RECORDS[int(options.get("index_bytes", 2))]
            whole = self.count > 0 and size % (self.record.itemsize * self.count) == 0
            self.width = size // self.count if whole else 0  # a file of another size has no rows
        else:
            self.width = {"points": 8, "vscales": 4, "vectors": int(options.get("dims", 128))}[self.kind]
        self.rows = min(self.count, size // self.width) if self.width else 0

    def partitions(self) -> list[RowRange]:
        return [RowRange(a, min(a + ROWS, self.rows)) for a in range(0, self.rows, ROWS)] or [RowRange(0, 0)]

    def read(self, part: RowRange) -> Iterator[pa.RecordBatch]:
        n = part.end - part.start
        if not n:
            return
        data = files.read(self.path, part.start * self.width, n * self.width)
        i = pa.array(np.arange(part.start, part.end, dtype="i4"))

        def lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
            k = len(values) // n
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype="i4") * k), pa.array(values).cast(kind))

        if self.kind == "neighbors":
            r = np.frombuffer(data, self.record)
            yield pa.RecordBatch.from_arrays([i, lists(r["idx"].astype("i4"), pa.int32()), lists(r["sim"].astype("i2"), pa.int16())], names=["i", "idx", "sim"])
        elif self.kind == "points":
            xy = np.frombuffer(data, "<f4").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([i, pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy())], names=["i", "x", "y"])
        elif self.kind == "vectors":
            yield pa.RecordBatch.from_arrays([i, lists(np.frombuffer(data, "i1"), pa.int8())], names=["i", "q"])
        else:
            yield pa.RecordBatch.from_arrays([i, pa.array(np.frombuffer(data, "<f4"))], names=["i", "scale"])


class PackedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "marani_packed"

    def schema(self) -> str:
        return SCHEMAS[self.options["kind"]]

    def reader(self, schema: object) -> PackedReader:
        return PackedReader(dict(self.options))


def read_packed(spark: SparkSession, path: str, kind: str, count: int, dims: int = 128, index_bytes: int = 2) -> DataFrame:
    spark.dataSource.register(PackedSource)
    return spark.read.format("marani_packed").options(path=path, kind=kind, count=count, dims=dims, index_bytes=index_bytes).load()
