"""Streaming forms of the attempt reports, over a stream of attempts with an event time.

These are additions: the batch operators fold a recorded log; these follow a log that is still growing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import is_strike


def _timed(attempts: DataFrame, late: str) -> DataFrame:
    return attempts.withColumn("ts", F.timestamp_micros("ts_us")).withWatermark("ts", late)


def hourly_outcomes(attempts: DataFrame, late: str = "10 minutes", length: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Per provider and sliding window: tries, fetched, strikes, bytes. Rows later than ``late`` are left out."""
    return _timed(attempts, late).groupBy(F.window("ts", length, slide), "provider").agg(
        F.count(F.lit(1)).alias("tries"), F.count_if(F.col("outcome") == "fetched").alias("fetched"), F.count_if(is_strike(F.col("outcome"))).alias("strikes"), F.sum("bytes").alias("bytes"),
    )


def distinct_attempts(attempts: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Attempts without repeats of an id that arrive within the watermark."""
    return _timed(attempts, late).dropDuplicatesWithinWatermark(["id"])
