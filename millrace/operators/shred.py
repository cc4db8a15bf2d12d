"""Shredding of API responses, id lists and proxy lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.carried import Fold, carried
from millrace.functions.scalars import parse_duration, strip, video_id

#: Texts are read as variants, so that a number in the place of a text is told apart from it.
RESPONSE = (
    "items array<struct<id: variant, snippet: struct<title: variant, channelId: variant, channelTitle: variant, publishedAt: variant, liveBroadcastContent: variant, "
    "defaultAudioLanguage: variant, defaultLanguage: variant>, contentDetails: struct<duration: variant, contentRating: struct<ytRating: variant>>, "
    "status: struct<license: variant, privacyStatus: variant, madeForKids: variant>>>"
)
PORTS = {"http": 80, "https": 443, "socks5": 1080, "socks5h": 1080}


def items(responses: DataFrame) -> DataFrame:
    """responses(body) -> a row per video item; bad JSON, no items, or an item whose id is no text give no row.

    Texts that are absent or no texts read as empty, absent or bad durations as 0, live as "none", flags as false.
    """
    parsed = F.from_json("body", RESPONSE)

    def of(path: str, kind: str = "string") -> Column:
        value = F.col(f"i.{path}")
        return F.when(F.schema_of_variant(value) == kind.upper(), F.try_variant_get(value, "$", kind))

    rows = responses.select(F.explode(parsed["items"]).alias("i")).withColumn("_id", of("id")).filter("_id IS NOT NULL")
    text = lambda path: F.coalesce(of(path), F.lit(""))
    return rows.select(
        F.col("_id").alias("id"), text("snippet.title").alias("title"), text("snippet.channelId").alias("channel_id"), text("snippet.channelTitle").alias("channel_title"),
        text("snippet.publishedAt").alias("published_at"), F.coalesce(parse_duration(text("contentDetails.duration")), F.lit(0)).alias("duration_s"),
        text("status.license").alias("license"), F.coalesce(of("snippet.liveBroadcastContent"), F.lit("none")).alias("live"),
        (text("contentDetails.contentRating.ytRating") == "ytAgeRestricted").alias("age_restricted"),
        F.coalesce(of("status.madeForKids", "boolean"), F.lit(False)).alias("made_for_kids"), text("status.privacyStatus").alias("privacy"),
        F.coalesce(of("snippet.defaultAudioLanguage"), of("snippet.defaultLanguage")).alias("language"),
    )


def id_lines(lines: DataFrame) -> DataFrame:
    """lines(line_no, line) -> (line_no, id, ok): blank lines and comments go; ok says whether the line holds an id."""
    text = strip(F.col("line"))
    rows = lines.select("line_no", text.alias("text")).filter((F.length("text") > 0) & ~F.col("text").startswith("#"))
    return rows.select("line_no", video_id(F.col("text")).alias("id"), video_id(F.col("text")).isNotNull().alias("ok"))


def strict_ids(lines: DataFrame) -> DataFrame:
    """The same, but a bad line fails the read; the error names the first one of the list, whichever task meets one."""
    rows = id_lines(lines)
    first = rows.agg(F.min(F.when(~F.col("ok"), F.col("line_no"))).alias("bad"))  # one row
    told = F.raise_error(F.concat(F.lit("line "), F.col("bad").cast("string"), F.lit(": not a video id")))
    return rows.crossJoin(F.broadcast(first)).select("line_no", F.when(F.col("bad").isNull(), F.col("id")).otherwise(told).alias("id"))


def proxies(lines: DataFrame) -> DataFrame:
    """lines(line_no, line) -> (line_no, provider, label, error): "<provider> <url>" or "<url>" per line.

    The label is provider/host:port; addresses with a user name get #k, k - 1 being the number of earlier ones whose label
    begins with that provider, host and port: also those of a longer port that begins with the same digits. error: not a proxy
    URL, a scheme that is not supported, or listed twice; it never holds the line, which may name a password.

    Each address counts for its own place and for the places that its port's shorter beginnings name, so labels with an
    equal beginning meet on an equal key. One place may have any share of the list.
    """
    text = strip(F.col("line"))
    rows = lines.select("line_no", text.alias("text")).filter((F.length("text") > 0) & ~F.col("text").startswith("#"))
    two = F.col("text").rlike(r"\s")
    rows = rows.select("line_no", F.when(two, F.regexp_extract("text", r"^(\S+)", 1)).otherwise("default").alias("provider"), F.when(two, strip(F.regexp_extract("text", r"^\S+\s+(.*)$", 1))).otherwise(F.col("text")).alias("url"))
    part = lambda name: F.try_parse_url("url", F.lit(name))
    scheme = F.lower(part("PROTOCOL"))
    port = F.regexp_extract(F.coalesce(part("AUTHORITY"), F.lit("")), r":([0-9]+)$", 1)
    known = F.lit(None).cast("string")
    for name, number in PORTS.items():
        known = F.when(scheme == name, F.lit(str(number))).otherwise(known)
    port = F.when(port != "", port).otherwise(known)
    host = F.concat("provider", F.lit("/"), part("HOST"), F.lit(":"))
    rows = rows.select("line_no", "provider", scheme.alias("scheme"), host.alias("host"), port.alias("port"), (F.coalesce(part("USERINFO"), F.lit("")) != "").alias("user"))
    rows = rows.withColumn("place", F.concat("host", "port"))
    ok = F.col("place").isNotNull() & F.col("scheme").isin(*PORTS)
    begins = F.transform(F.sequence(F.lit(1), F.length("port")), lambda n: F.concat(F.col("host"), F.substring(F.col("port"), F.lit(1), n)))
    keyed = rows.filter(ok).select("line_no", "place", "user", F.explode(begins).alias("key"))
    counted = carried(keyed, ("key",), ("line_no",), earlier=Fold("sum", F.lit(1), before=True)).filter("key = place")
    label = F.when(F.col("user"), F.concat("place", F.lit("#"), (F.col("earlier") + 1).cast("string"))).otherwise(F.col("place"))
    counted = counted.select("line_no", label.alias("label"))
    again = carried(counted, ("label",), ("line_no",), times=Fold("sum", F.lit(1), before=True))
    out = rows.join(again, "line_no", "left")
    error = F.when(F.col("scheme").isNull() | F.col("place").isNull() & F.col("scheme").isin(*PORTS), "not a proxy URL").when(~F.col("scheme").isin(*PORTS), "unsupported scheme").when(F.col("times") > 0, "listed twice")
    return out.select("line_no", "provider", "label", error.alias("error"))


def strict_proxies(lines: DataFrame) -> DataFrame:
    """(line_no, provider, label), but a bad line fails the read; the error names the first one of the list and its reason."""
    rows = proxies(lines)
    first = rows.agg(F.min(F.when(F.col("error").isNotNull(), F.struct("line_no", "error"))).alias("bad"))  # one row
    told = F.raise_error(F.concat(F.lit("line "), F.col("bad.line_no").cast("string"), F.lit(": "), F.col("bad.error")))
    return rows.crossJoin(F.broadcast(first)).select("line_no", "provider", F.when(F.col("bad").isNull(), F.col("label")).otherwise(told).alias("label"))
