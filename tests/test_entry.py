from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return str(v)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't there")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted("|".join(norm(r[c]) for c in cols) for r in df.collect())
    found = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert got == sorted("|".join(norm(r[names.index(c)]) for c in cols) for r in found.fetchall())


@pytest.mark.parametrize("highest", [65_535, 65_536, 2**31 - 1])
@pytest.mark.parametrize("name", ["neighbour_file", "packed_neighbours"])
def test_neighbours_of_large_tables(spark, tmp_path, name, highest):
    rows = [(i, [(highest - i - n * 4111) % (highest + 1) for n in range(15)], [255 - n - i % 7 for n in range(15)]) for i in (0, 2, 70_000)]
    spark.createDataFrame([*rows, rows[0], (1, None, None)], "i int, nidx array<int>, nsim array<int>").write.parquet(f"{tmp_path}/layout.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW layout AS SELECT * FROM '{tmp_path}/layout.parquet/*.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    got, found = df.collect(), con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in found.description]
    assert len(got) == 45
    assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
