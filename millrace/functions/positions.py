"""Exact global positions without gathering the rows in one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.carried import Fold, carried
from millrace.scratch import fresh_dir


def _placed(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """df in range partitions of the order, written down with the number of its partition as _part."""
    spark = df.sparkSession
    placed = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    path = fresh_dir(spark, "positions")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def with_running_sum(df: DataFrame, value: str, *order: str, name: str) -> DataFrame:
    """df plus the sum of ``value`` up to each row in the order of the given columns, which must name each row.

    Done as ``with_position`` does it: sums within range partitions, plus one number per partition. Rows are written when this is called.
    """
    placed = _placed(df, order)
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_n"))
    offsets = sums.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per partition
    local = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("_sum", local).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_sum")).drop("_part", "_sum", "_before")


def with_sum_since(df: DataFrame, add: Column, reset: Column, group: str, *order: str, name: str) -> DataFrame:
    """df plus, within each group in the given order, the sum of ``add`` (0 or more) after the last row where ``reset``.

    No group stands in one task: see ``carried``, which writes the rows once."""
    return carried(df, (group,), order, **{name: Fold("since", add, reset)})


def with_position(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """df plus its row number (from 0) in the order of the given columns, which must name each row.

    Rows are range-partitioned and written with their partition when this is called, so both passes see the same split:
    select what is needed first. The offsets are one number per partition, which bounds the broadcast.
    """
    placed = _placed(df, order)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per partition
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return placed.withColumn("_row", local).join(F.broadcast(offsets), "_part").withColumn(name, (F.col("_before") + F.col("_row") - 1).cast("long")).drop("_part", "_row", "_before")
