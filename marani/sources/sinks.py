"""Sinks. Tables stay Parquet inside; the published dataset is an export of at most 65,535 rows, whose files are single and in order.

An ordered single file is written from a sorted iterator of the driver, a partition at a time, never from one list of all rows."""

from __future__ import annotations

import hashlib
import io
import itertools
import json
import struct
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.neighbours import pack_neighbours
from . import files


def write_jsonl(df: DataFrame, path: str) -> int:
    """Write JSON lines and return their number, which is counted on the way."""
    from pyspark.sql import Observation

    seen = Observation("written")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def write_lines(df: DataFrame, col: str, path: str) -> None:
    """One text on each line, as the older corpora are."""
    df.select(col).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; white space at the ends of values stays."""
    kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**kept).csv(path)


def _ordered(df: DataFrame, path: str, one: Callable[[Row], bytes], order: str = "i") -> int:
    return files.write(path, map(one, df.orderBy(order).toLocalIterator()))


def write_labels(vocab: DataFrame, path: str) -> int:
    return _ordered(vocab.select("i", "word", F.coalesce("freq", F.lit(0)).alias("freq")), path, lambda r: f"{r['word']}\t{r['freq']}\n".encode())


def write_points(points: DataFrame, path: str) -> int:
    return _ordered(points, path, lambda r: struct.pack("<2f", r["x"], r["y"]))


def write_neighbours(neighbours: DataFrame, path: str, index_bytes: int = 2) -> int:
    return _ordered(pack_neighbours(neighbours, index_bytes), path, lambda r: bytes(r["record"]))


def write_vectors(quantized: DataFrame, vectors_path: str, scales_path: str) -> tuple[int, int]:
    """``quantized`` has i and quantized STRUCT<q, scale>."""
    q = quantized.select("i", F.col("quantized.q").alias("q"), F.col("quantized.scale").alias("scale"))
    return _ordered(q, vectors_path, lambda r: np.array(r["q"], "i1").tobytes()), _ordered(q, scales_path, lambda r: struct.pack("<f", r["scale"]))


def write_matrix(vectors: DataFrame, path: str) -> int:
    """A NumPy file of single precision, a row for each vector in the order of ``i``."""
    count, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    head = io.BytesIO()
    np.lib.format.write_array_header_1_0(head, {"descr": "<f4", "fortran_order": False, "shape": (count, width or 0)})
    rows = (np.asarray(r["vec"], "<f4").tobytes() for r in vectors.select("i", "vec").orderBy("i").toLocalIterator())
    return files.write(path, itertools.chain([head.getvalue()], rows))


def config_hash(config: dict) -> str:
    """SHA-256 of a configuration in JSON with sorted keys, without the keys that begin with an underscore."""
    return hashlib.sha256(json.dumps({k: v for k, v in config.items() if not k.startswith("_")}, sort_keys=True).encode()).hexdigest()


# The version and the fields of a dataset's record, and the columns of the index of datasets.
VERSION = 2
RECORD = "id corpus model name_ka name_en prompt layer N per_article_cap window_tokens seeds dim128_method umap vocab_hash config_hash count dims_full dims_i8 aligned_group reference displacement".split()
INDEX = "id string, corpus string, model string, name_ka string, name_en string, count long, dims_full long, dims_i8 long, aligned_group string, reference boolean, files map<string,long>, emoji boolean"


def record(**fields: object) -> dict:
    """The record of a dataset, by which it can be made again; a field that is missing or unknown is an error."""
    if set(fields) != set(RECORD):
        raise ValueError(f"fields of the record that are missing or unknown: {sorted(set(fields) ^ set(RECORD))}")
    return {"v": VERSION} | {k: fields[k] for k in RECORD} | {"generated_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")}


def catalog_upsert(catalog: DataFrame, entries: DataFrame, key: str = "id") -> DataFrame:
    """The catalog with entries of the same id replaced, in the order of ids."""
    return catalog.join(entries.select(key), key, "left_anti").unionByName(entries, allowMissingColumns=True).orderBy(key)


def write_json(path: str, content: object) -> None:
    files.write(path, [json.dumps(content, ensure_ascii=False, indent=2).encode()])


def read_json(path: str) -> object:
    return json.loads(files.read(path))


def put_into_index(spark: SparkSession, folder: str, meta: dict, sizes: dict[str, int], emoji: bool | None = None) -> None:
    """Put a dataset into the index of its folder, in place of an entry with its id. Columns that the index doesn't have go."""
    path, names = f"{folder}/index.json", [f.split(" ")[0] for f in INDEX.split(", ")]
    known = read_json(path) if files.size(path) is not None else []
    own = {k: meta.get(k) for k in names} | {"model": meta["name_en"], "files": sizes, "emoji": emoji}
    table = lambda entries: spark.createDataFrame([tuple(e.get(k) for k in names) for e in entries], INDEX)
    rows = catalog_upsert(table(known), table([own])).collect()  # a row for each dataset of a folder
    write_json(path, [{k: v for k, v in r.asDict().items() if k != "emoji" or v} for r in rows])


def write_dataset(folder: str, meta: dict, vocab: DataFrame, points: DataFrame, neighbours: DataFrame, quantized: DataFrame) -> dict[str, int]:
    """Write the five files and the record of a dataset and put it into the index beside it; returns the sizes of the files."""
    at = f"{folder}/{meta['id']}"
    sizes = {"labels.tsv": write_labels(vocab, f"{at}/labels.tsv"), "points.f32": write_points(points, f"{at}/points.f32"), "neighbors.bin": write_neighbours(neighbours, f"{at}/neighbors.bin")}
    sizes["vectors.i8"], sizes["vscales.f32"] = write_vectors(quantized, f"{at}/vectors.i8", f"{at}/vscales.f32")
    write_json(f"{at}/meta.json", meta)
    put_into_index(vocab.sparkSession, folder, meta, sizes)
    return sizes


def files_table(spark: SparkSession, folder: str) -> DataFrame:
    """``name``, ``length`` of all files below a folder, whose contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def write_projector(vectors: DataFrame, folder: str, name: str) -> dict:
    """Tensor bytes, tensor and label tables for an embedding projector, and its configuration, which is returned."""
    bad = vectors.where("word IS NULL OR word = '' OR instr(word, '\t') > 0").limit(1).count()
    if bad:
        raise ValueError("labels must be words without tabs")
    widths = [r[0] for r in vectors.select(F.size("vec")).distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError("all vectors must have one length")
    rows = vectors.select("i", "word", "count", "vec")

    def lines(text: Callable[[Row], str], head: str = "") -> Iterator[str]:
        yield head
        for n, r in enumerate(rows.orderBy("i").toLocalIterator()):
            yield ("\n" if n and not head else "") + text(r)

    _ordered(rows, f"{folder}/{name}_tensors.bytes", lambda r: np.array(r["vec"], "<f4").tobytes())
    files.write(f"{folder}/{name}_tensors.tsv", (x.encode() for x in lines(lambda r: "\t".join(f"{np.float32(x):.8f}" for x in r["vec"]))))
    files.write(f"{folder}/{name}_labels.tsv", (x.encode() for x in lines(lambda r: f"{r['word'].lower()}\t{r['count']}\n", "word\tcount\n")))
    return {"embeddings": [{"tensorName": name, "tensorShape": [rows.count(), widths[0] if widths else 0], "tensorPath": f"{folder}/{name}_tensors.bytes", "metadataPath": f"{folder}/{name}_labels.tsv"}]}


def write_word2vec_text(vectors: DataFrame, path: str) -> None:
    """The text format of word vectors: a head of number and length, then a word and its numbers on each line."""
    count, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    rows = (r["word"] + " " + " ".join(repr(float(x)) for x in r["vec"]) + "\n" for r in vectors.orderBy("word").toLocalIterator())
    files.write(path, (x.encode() for x in itertools.chain([f"{count} {width or 0}\n"], rows)))


def resumable(df: DataFrame, path: str, key: str, make: Callable[[DataFrame], DataFrame], parts: int = 16) -> DataFrame:
    """Make rows part by part of their key and keep each part's table as it is finished; parts that are there aren't made again."""
    spark = df.sparkSession
    schema = make(df.limit(0)).schema
    for part in range(parts):
        at = f"{path}/part={part}"
        jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        if not jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
            make(df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)).write.mode("overwrite").parquet(at)
    return spark.read.schema(schema).parquet(*(f"{path}/part={p}" for p in range(parts)))
