"""Ordered admission rules: one recorded reason, the first that applies; null means accepted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import Filters


def reason(f: Filters = Filters()) -> Column:
    """One CASE over license, privacy, live, age_restricted, made_for_kids and duration_s; switched-off rules are left out."""
    rules = [(~F.col("license").isin(*f.licenses), F.concat(F.lit("license:"), "license")), (F.col("privacy") == "private", F.lit("private"))]
    if f.skip_live:
        rules.append((F.col("live") != "none", F.concat(F.lit("live:"), "live")))
    if f.skip_age_restricted:
        rules.append((F.col("age_restricted"), F.lit("age_restricted")))
    if f.skip_made_for_kids:
        rules.append((F.col("made_for_kids"), F.lit("made_for_kids")))
    rules.append((~F.col("duration_s").between(f.min_duration_s, f.max_duration_s), F.concat(F.lit("duration:"), F.col("duration_s").cast("string"))))
    out = F.when(*rules[0])
    for rule in rules[1:]:
        out = out.when(*rule)
    return out


def check(videos: DataFrame, f: Filters = Filters()) -> DataFrame:
    """videos plus reason and status (accepted or rejected)."""
    return videos.withColumn("reason", reason(f)).withColumn("status", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected"))


def rejected_by_reason(checked: DataFrame) -> DataFrame:
    return checked.filter("reason IS NOT NULL").groupBy(F.split_part("reason", F.lit(":"), F.lit(1)).alias("class")).agg(F.count(F.lit(1)).alias("n"))
