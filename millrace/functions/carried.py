"""Folds over the rows of a group in order, where one group may hold any share of all rows.

A window over a group gathers it in one task. Here the rows are range-partitioned by (group, order) instead; a fold goes over
the rows of a partition, and what it has come to at the end of a partition is carried into the next one that goes on with the
same group: one row a partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.scratch import fresh_dir


@dataclass(frozen=True)
class Fold:
    """sum (0 over no rows), max, last (the last value that is not null), or since: the sum after the last row where ``reset``,
    which is 0 at that row. ``before``: up to the row before, else up to the row itself."""

    kind: str
    value: Column
    reset: Column | None = None
    before: bool = False

    def __post_init__(self):
        if self.kind not in ("sum", "max", "last", "since") or (self.kind == "since") != (self.reset is not None) or (self.kind == "since" and self.before):
            raise ValueError(f"no such fold: {self}")


def _over(kind: str, value: Column, window) -> Column:
    return {"sum": F.sum(value), "max": F.max(value), "last": F.last(value, ignorenulls=True)}[kind].over(window)


def _joined(kind: str, earlier: Column, later: Column) -> Column:
    """One value of two stretches of rows that follow each other."""
    if kind == "max":
        return F.greatest(earlier, later)  # passes over nulls
    if kind == "last":
        return F.coalesce(later, earlier)
    return F.coalesce(earlier, F.lit(0)) + F.coalesce(later, F.lit(0))


def carried(df: DataFrame, group: tuple[str, ...], order: tuple[str, ...], **folds: Fold) -> DataFrame:
    """df plus a column for each fold over the rows of ``group`` (none: all rows) in ``order``, which must name each row of a
    group; nulls come first and are a group of their own.

    The rows are shuffled twice and written once below the shared folder, when this is called: select what is needed first.
    No task gets more than a range partition, but rows that agree in group and order stay together.
    """
    if clash := [c for c in df.columns if c.startswith("_c_")]:
        raise ValueError(f"columns that start with _c_ are in use here: {clash}")
    spark = df.sparkSession
    names = list(df.columns)
    rows = df.withColumns({f"_c_v_{n}": f.value for n, f in folds.items()} | {f"_c_r_{n}": F.coalesce(f.reset, F.lit(False)) for n, f in folds.items() if f.reset is not None})
    rows = rows.repartitionByRange(*group, *order).withColumn("_c_part", F.spark_partition_id())
    window = Window.partitionBy("_c_part", *group).orderBy(*order)
    upto, earlier = (window.rowsBetween(Window.unboundedPreceding, k) for k in (0, -1))
    ends: dict[str, Column] = {}
    for n, f in folds.items():
        value = F.col(f"_c_v_{n}")
        if f.kind == "since":
            rows = rows.withColumn(f"_c_k_{n}", F.sum(F.col(f"_c_r_{n}").cast("long")).over(upto))
            run = Window.partitionBy("_c_part", *group, f"_c_k_{n}").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.withColumn(f"_c_i_{n}", F.sum(F.when(F.col(f"_c_r_{n}"), 0).otherwise(value)).over(run))
            ends[f"k_{n}"] = F.col(f"_c_k_{n}")
        else:
            rows = rows.withColumn(f"_c_i_{n}", _over(f.kind, value, upto))
            if f.before:
                rows = rows.withColumn(f"_c_x_{n}", _over(f.kind, value, earlier))
        ends[f"i_{n}"] = F.col(f"_c_i_{n}")
    rows = rows.drop(*[f"_c_v_{n}" for n in folds], *[f"_c_r_{n}" for n in folds])
    path = fresh_dir(spark, "carried")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)

    key = F.struct(F.lit(0).alias("_c_all"), *group)
    ended = F.max_by(F.struct(*[c.alias(k) for k, c in ends.items()]), F.struct(*group, *order)).alias("end")
    parts = rows.groupBy("_c_part").agg(F.min(key).alias("first"), F.max(key).alias("last"), ended)  # a row per partition
    same = Window.partitionBy("last").orderBy("_c_part").rowsBetween(Window.unboundedPreceding, 0)
    sums = {}
    for n, f in folds.items():
        if f.kind == "since":
            parts = parts.withColumn(f"_k_{n}", F.sum(F.when(F.col(f"end.k_{n}") > 0, 1).otherwise(0)).over(same))
            run = Window.partitionBy("last", f"_k_{n}").orderBy("_c_part").rowsBetween(Window.unboundedPreceding, 0)
            sums[n] = F.sum(f"end.i_{n}").over(run)
        else:
            sums[n] = _over(f.kind, F.col(f"end.i_{n}"), same)
    parts = parts.select("_c_part", "first", F.struct("last", *[c.alias(n) for n, c in sums.items()]).alias("end"))
    parts = parts.withColumn("_c_in", F.lag("end").over(Window.orderBy("_c_part")))
    parts = parts.filter(F.col("first") == F.col("_c_in.last")).select("_c_part", F.col("first").alias("_c_first"), "_c_in")
    rows = rows.join(F.broadcast(parts), "_c_part", "left")
    goes_on = F.coalesce(F.col("_c_first") == key, F.lit(False))
    out = []
    for n, f in folds.items():
        mine, kind = F.col(f"_c_{'x' if f.before else 'i'}_{n}"), "sum" if f.kind == "since" else f.kind
        enter = goes_on & (F.col(f"_c_k_{n}") == 0) if f.kind == "since" else goes_on
        whole = F.when(enter, _joined(kind, F.col("_c_in")[n], mine)).otherwise(mine)
        out.append((F.coalesce(whole, F.lit(0)).cast("long") if kind == "sum" else whole).alias(n))
    return rows.select(*[F.col(f"`{c}`") for c in names], *out)
