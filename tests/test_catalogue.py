"""Every registered query with SQL gives the rows that DuckDB gives."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from millrace.plans import catalogue


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def text(v):
    return "" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_rows(spark, sf_dir, duck, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = duck.sql(catalogue.ORACLES[name])
    assert sorted(rel.columns) == columns
    mine = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    at = [rel.columns.index(c) for c in columns]
    theirs = sorted(tuple(text(r[i]) for i in at) for r in rel.fetchall())
    assert mine == theirs


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 4


def test_filters_reach_the_scan(spark, sf_dir, capsys):
    catalogue.QUERIES["quota_by_day"](spark, sf_dir).explain("formatted")
    scan = capsys.readouterr().out
    assert "props" not in scan.split("ReadSchema")[1].splitlines()[0]
