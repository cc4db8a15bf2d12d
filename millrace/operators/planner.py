"""Batches, shards and slots; what is already done is left out by anti-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.positions import with_position
from millrace.functions.scalars import is_direct, record_path, shard_name


def shard_layout(videos: DataFrame, size: int) -> DataFrame:
    """videos plus shard, pos in it, file and record path: direct hits first, then by seq, ``size`` to a shard."""
    if size <= 0:
        raise ValueError("shard size must be positive")
    placed = with_position(videos.withColumn("_late", ~is_direct(F.col("source"))), "_late", "seq", name="_at").drop("_late")
    shard = F.floor(F.col("_at") / size).cast("long")
    return placed.withColumn("shard", shard).withColumn("pos", F.pmod("_at", F.lit(size)).cast("long")).drop("_at").withColumn("file", shard_name(F.col("shard"))).withColumn("record", record_path(F.col("id")))


def shards(layout: DataFrame) -> DataFrame:
    return layout.groupBy("batch", "shard").agg(F.count(F.lit(1)).alias("videos"))


def slot_assignment(shard_list: DataFrame, world: int, jobs: int, batch: str | None = None) -> DataFrame:
    """shard_list(batch, shard) plus index (oldest batch first), slot, rank and job of the slot.

    With ``batch`` only its shards are numbered and dealt."""
    if batch is not None:
        shard_list = shard_list.filter(F.col("batch") == batch)
    out = with_position(shard_list, "batch", "shard", name="index").withColumn("slot", F.pmod("index", F.lit(world * jobs)).cast("long"))
    return out.withColumn("rank", F.floor(F.col("slot") / jobs).cast("long")).withColumn("job", F.pmod("slot", F.lit(jobs)).cast("long"))


def skip_done_records(entries: DataFrame, records: DataFrame) -> DataFrame:
    """entries plus done and bytes: a record (id, bytes) means fetched without a download."""
    found = records.select("id", F.col("bytes").alias("_bytes"), F.lit(True).alias("_done"))
    return entries.join(found, "id", "left").withColumn("done", F.coalesce("_done", F.lit(False))).withColumn("bytes", F.coalesce("_bytes", F.lit(0)).cast("long")).drop("_bytes", "_done")


def skip_done_shards(shard_list: DataFrame, manifests: DataFrame) -> DataFrame:
    """Shards without a manifest."""
    return shard_list.join(manifests.select("batch", "shard").distinct(), ["batch", "shard"], "left_anti")


def batch_progress(batches: DataFrame, manifests: DataFrame) -> DataFrame:
    """Per batch: videos and shards planned, shards done, outcomes, bytes and seconds of what was fetched.

    manifests: one line per video (batch, shard, status, bytes, duration_s); any status but fetched and unavailable
    counts as failed.
    """
    got = F.col("status") == "fetched"
    done = manifests.groupBy("batch").agg(
        F.count_distinct("shard").alias("shards_done"), F.count_if(got).alias("fetched"), F.count_if(F.col("status") == "unavailable").alias("unavailable"),
        F.count_if(~F.col("status").isin("fetched", "unavailable")).alias("failed"), F.sum(F.when(got, F.col("bytes")).otherwise(0)).alias("bytes"),
        F.sum(F.when(got, F.col("duration_s")).otherwise(0)).alias("seconds"),
    )
    names = ("shards_done", "fetched", "unavailable", "failed", "bytes", "seconds")
    return batches.join(done, "batch", "left").select("batch", "videos", "shards", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])


def batch_total(progress: DataFrame) -> DataFrame:
    """One row of sums if there are at least two batches; shards done are not totalled."""
    names = ("videos", "shards", "fetched", "unavailable", "failed", "bytes", "seconds")
    return progress.agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).cast("long").alias(c) for c in names]).filter("batches > 1")
