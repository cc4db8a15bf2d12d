"""Shared helpers of the corpus operators: lineage cuts, bounded batches and white space."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import fresh_dir, shared_dir

#: The six characters of ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\f\r"

#: The type that stands for "no doc_id" where ids are ordered or joined: smaller than any real id.
NO_ID = -(2**63)
#: Bytes of an Arrow batch on its way to a Python worker, and rows that a Parquet scan decodes at once. A batch holds one
#: row at least, however long its text is.
BATCH_BYTES, SCAN_ROWS = 1 << 20, 512
_BATCH_CONF, _SCAN_CONF = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes and the batches of its Parquet scans by few rows, unless they are
    bounded closer already. By default both are bounded by thousands of rows, which says little about long texts.
    """
    for name, most in ((_BATCH_CONF, BATCH_BYTES), (_SCAN_CONF, SCAN_ROWS)):
        now = spark.conf.get(name, None)
        if now is None or not now.isdigit() or int(now) > most:
            spark.conf.set(name, most)


def arrow_fields(rows: DataFrame) -> str:
    """The columns of ``rows`` as the DDL of a map's output."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def node_id(id_col: str, text_col: str) -> Column:
    """The id as a long. A row without an id gets one below -2**62 from its text, so that it comes before all others;
    rows without an id are the same document only if their texts are equal. Real ids are taken to be above that."""
    own = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), 2)
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), own)


def real_id(column: str | Column) -> Column:
    """What ``node_id`` was made from: null for a row without an id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column >= -(2**62), column)


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FREED_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that runs in here are deleted when it ends, not when the driver happens to collect its
    garbage: for large shuffles, one after the other."""
    before = spark.conf.get(_FREED_CONF)
    spark.conf.set(_FREED_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED_CONF, before)


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() into the shared folder, for small tables that a loop carries from round to round."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(column: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
