"""The queries that SQL can express, against DuckDB; all queries over odd and empty tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from millrace.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_rows(spark, sf_dir, name):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = c.sql(queries.ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(x) for x in columns]
    mine = sorted(tuple(str(r[x]) for x in columns) for r in df.collect())
    assert mine == sorted(tuple(str(r[i]) for i in at) for r in rel.fetchall())


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory, spark, odd_docs):
    d = str(tmp_path_factory.mktemp("odd"))
    odd_docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0), (6, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 0.0]), (9, []), (10, [1.0]), (None, [0.0, 1.0])]
    spark.createDataFrame([(*v, 0) for v in vectors], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    turns = [(1, 0, "user", "a?"), (1, 0, "user", "a?"), (1, None, None, None), (2, 1, "", ""), (None, 5, "assistant", "b."), (3, 0, "system", "y" * 100_000)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return d


#: Rows over the odd tables: vectors, usable vectors, conversations, pieces; all others give a row per document.
ODD_ROWS = {"op4": 11, "op11": 7, "op12": 4, "op13": 9}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_odd_rows(spark, odd_dir, name):
    rows = queries.QUERIES[name](spark, odd_dir).collect()
    if name.startswith("op13"):
        rows = [r for r in rows if r.piece == 0]
    assert len(rows) == ODD_ROWS.get(name.split("_")[0], 9)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path_factory, no_docs, name):
    d = str(tmp_path_factory.mktemp("none"))
    no_docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    assert queries.QUERIES[name](spark, d).count() == 0
