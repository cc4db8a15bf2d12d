"""Folds over groups of any size, and the operators that rest on them, with one key that holds most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.carried import Fold, carried


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small tables would else be put together in one partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def busy(spark):
    """(g, t, id, v, r): one group holds half of all rows; some values are null."""
    rng = random.Random(1)
    rows = []
    for i in range(4000):
        g = None if i % 97 == 0 else "busy" if i % 2 else f"g{rng.randrange(40)}"
        rows.append((g, rng.randrange(900), i, rng.choice([None, *range(-5, 9)]), rng.random() < 0.02))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, t long, id long, v long, r boolean").repartition(5)


def folds():
    return {
        "s": Fold("sum", F.col("v")), "sb": Fold("sum", F.lit(1), before=True), "m": Fold("max", F.col("v"), before=True), "mi": Fold("max", F.struct("v", "id")),
        "l": Fold("last", F.when(F.col("v") > 5, F.col("id"))), "lb": Fold("last", F.when(F.col("v") > 7, F.struct("id", "v")), before=True), "q": Fold("since", F.coalesce("v", F.lit(0)), F.col("r")),
    }


def plain(rows, grouped):
    out, state = {}, {}
    for g, t, i, v, r in sorted(rows, key=lambda x: ((x[0] is not None, x[0] or "") if grouped else (), x[1], x[2])):
        s = state.setdefault(g if grouped else 0, {"s": 0, "n": 0, "m": None, "mi": None, "l": None, "lb": None, "q": 0})
        sb, m, lb = s["n"], s["m"], s["lb"]
        s["s"] += v or 0
        s["n"] += 1
        s["m"] = v if s["m"] is None or (v is not None and v > s["m"]) else s["m"]
        key = (v is not None, v or 0, i, v)
        s["mi"] = key if s["mi"] is None or key > s["mi"] else s["mi"]
        s["l"] = i if v is not None and v > 5 else s["l"]
        s["lb"] = (i, v) if v is not None and v > 7 else s["lb"]
        s["q"] = 0 if r else s["q"] + (v or 0)
        out[i] = (s["s"], sb, m, (s["mi"][3], s["mi"][2]), s["l"], lb, s["q"])
    return out


@pytest.mark.parametrize("grouped", [True, False])
def test_folds(spark, busy, grouped):
    rows, df = busy
    found = carried(df, ("g",) if grouped else (), ("t", "id"), **folds())
    tup = lambda x: x if x is None else tuple(x)
    got = {r.id: (r.s, r.sb, r.m, tup(r.mi), r.l, tup(r.lb), r.q) for r in found.collect()}
    assert got == plain(rows, grouped)


def test_no_rows_and_clashing_names(spark, busy):
    assert carried(busy[1].limit(0), ("g",), ("t",), **folds()).count() == 0
    with pytest.raises(ValueError, match="_c_"):
        carried(busy[1].withColumn("_c_x", F.lit(1)), ("g",), ("t",), **folds())
    with pytest.raises(ValueError, match="no such fold"):
        Fold("min", F.col("v"))


def test_a_busy_group_is_dealt_over_tasks(spark, busy):
    """The sorts of the fold take a range partition each, however many rows one group has."""
    rows = busy[1].repartitionByRange("g", "t", "id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(rows) >= 4 and max(r["count"] for r in rows) < 2 * 4000 / len(rows)
