"""Progress and provider reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import is_strike


def provider_totals(attempts: DataFrame, ips: DataFrame) -> DataFrame:
    """Per provider: labels used, labels retired, tries, fetched, strikes, bytes, seconds held by fetches, media
    seconds, and the span of the log in seconds."""
    got = F.col("outcome") == "fetched"
    used = attempts.groupBy("provider").agg(
        F.count_distinct("label").alias("ips"), F.count(F.lit(1)).alias("tries"), F.count_if(got).alias("fetched"), F.count_if(is_strike(F.col("outcome"))).alias("strikes"),
        F.sum("bytes").cast("long").alias("bytes"), F.sum(F.when(got, F.col("seconds"))).alias("held_seconds"), F.sum("duration_s").cast("long").alias("duration_s"),
        ((F.max("ts_us") - F.min("ts_us")) / 1e6).alias("span_s"),
    )
    retired = ips.groupBy("provider").agg(F.count_if("retired").alias("retired"))
    return used.join(retired, "provider", "left").withColumn("retired", F.coalesce("retired", F.lit(0)).cast("long"))


def provider_report(totals: DataFrame, prices: dict[str, float]) -> DataFrame:
    """provider_totals plus rates: strike percentage, MB/s, fetches per label and day, media hours, cost per hour.

    prices: monthly cost of one label by provider; without a price, or without media, the cost is null. In order of provider.
    """
    days = F.greatest(F.col("span_s") / 86_400, F.lit(1 / 24))
    price = F.lit(None).cast("double")
    for provider, p in prices.items():
        price = F.when(F.col("provider") == provider, F.lit(float(p))).otherwise(price)
    hours = F.col("duration_s") / 3_600
    rates = totals.select(
        "provider", "ips", "retired", "tries", "fetched", "strikes", (100 * F.col("strikes") / F.greatest("tries", F.lit(1))).alias("strike_pct"),
        F.coalesce(F.col("bytes") / 1e6 / F.nullif(F.col("held_seconds"), F.lit(0.0)), F.lit(0.0)).alias("mb_per_s"),
        (F.col("fetched") / F.greatest("ips", F.lit(1)) / days).alias("per_ip_day"), hours.alias("hours"),
        F.when(hours > 0, F.col("ips") * price / 30 * days / hours).alias("cost_per_hour"),
    )
    return rates.orderBy("provider")  # a row per provider


def run_counters(attempts: DataFrame) -> DataFrame:
    """Per worker: tries by outcome, bytes and media seconds."""
    kinds = ("fetched", "unavailable", "failed", "bot_check", "proxy_error")
    return attempts.groupBy("worker").agg(*[F.count_if(F.col("outcome") == k).alias(k) for k in kinds], F.sum("bytes").cast("long").alias("bytes"), F.sum("duration_s").cast("long").alias("duration_s"))


def discover_counters(checks: DataFrame, pages: DataFrame, channels: DataFrame, ledger: DataFrame) -> DataFrame:
    """What a discovery run did, as (counter, n): ids added, accepted, rejected and gone, channels done, search pages,
    units used, and 1 or 0 for running out of quota.

    checks(status), a row per id: new, accepted, rejected or gone. pages(kind), a row per page read. channels(done).
    ledger(cost, refused).
    """
    one = lambda rows, name, n: rows.select(F.lit(name).alias("counter"), n.cast("long").alias("n"))
    flag = lambda x: F.when(x, 1).otherwise(0)
    status = F.col("status")
    parts = [one(checks, "added", F.lit(1))] + [one(checks, k, flag(status == k)) for k in ("accepted", "rejected", "gone")]
    parts += [one(channels, "channels", flag(F.col("done"))), one(pages, "search_pages", flag(F.col("kind") == "search")), one(ledger, "quota_used", flag(~F.col("refused")) * F.col("cost"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    out_of = ledger.agg(F.coalesce(F.max(flag(F.col("refused"))), F.lit(0)).cast("long").alias("n")).select(F.lit("out_of_quota").alias("counter"), "n")
    return out.groupBy("counter").agg(F.sum("n").alias("n")).union(out_of)


def record_bytes(records: DataFrame) -> DataFrame:
    """records plus bytes: the sum over their files(path, bytes, sha256)."""
    return records.withColumn("bytes", F.aggregate("files", F.lit(0).cast("long"), lambda a, f: a + f["bytes"]))


def media_pick(files: DataFrame) -> DataFrame:
    """Per id of files(id, name, bytes): the bytes of all its files but partial ones, and its media file.

    The media file is the largest that is not empty, named <id>.<ext> with a plain extension that is neither a
    caption nor a partial or side file; of equal sizes the first by name.
    """
    named = F.col("name").startswith(F.concat("id", F.lit(".")))
    ext = F.substr(F.col("name"), F.length("id") + 2)
    media = named & ~ext.contains(".") & ~ext.isin("vtt", "part", "ytdl", "json", "temp") & (F.col("bytes") > 0)
    best = F.min(F.when(media, F.struct((-F.col("bytes")).alias("less"), "name")))
    out = files.groupBy("id").agg(F.sum(F.when(named & ~F.col("name").endswith(".part"), F.col("bytes")).otherwise(0)).cast("long").alias("bytes"), best.alias("best"))
    return out.select("id", "bytes", F.col("best.name").alias("media"))
