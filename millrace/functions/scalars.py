"""Scalar functions as Column expressions; no Python UDF among them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that tell failures apart, in order of precedence.
PROXY_TEXTS = ("unable to connect to proxy", "tunnel connection failed", "proxyerror", "proxy authentication required", "socks")
BOT_TEXTS = ("not a bot", "http error 429", "too many requests", "rate-limited", "rate limited")
GONE_TEXTS = (
    "video unavailable", "private video", "this video is private", "has been removed", "no longer available", "has been terminated",
    "available in your country", "blocked it in your country", "members-only", "join this channel", "confirm your age",
    "inappropriate for some users", "premieres in", "live event will begin",
)
STRIKES = ("bot_check", "proxy_error")
UNIT_SECONDS = {"W": 604_800, "D": 86_400, "H": 3_600, "M": 60, "S": 1}


def parse_duration(text: Column) -> Column:
    """Seconds of an ISO 8601 duration of weeks, days, hours, minutes and seconds; null if it is none.

    Digits that stand before the T without a unit are taken on to the first unit after it.
    """
    rest = F.substr(text, F.lit(2))
    days = F.substring_index(rest, "T", 1)
    clock = F.when(rest.contains("T"), F.replace(F.substr(rest, F.length(days) + 2), F.lit("T"), F.lit(""))).otherwise(F.lit(""))
    open_digits = F.when(rest.contains("T"), F.regexp_extract(days, "([0-9]*)$", 1)).otherwise(F.lit(""))
    days = F.substr(days, F.lit(1), F.length(days) - F.length(open_digits))
    clock = F.concat(open_digits, clock)

    def total(part: Column, units: str) -> Column:
        def seconds(x: Column) -> Column:
            out = F.lit(None).cast("long")
            for u in units:
                out = F.when(x.endswith(u), F.lit(UNIT_SECONDS[u])).otherwise(out)
            return F.substr(x, F.lit(1), F.length(x) - 1).try_cast("long") * out

        return F.aggregate(F.regexp_extract_all(part, F.lit(f"[0-9]+[{units}]"), F.lit(0)), F.lit(0).cast("long"), lambda a, x: a + seconds(x))

    valid = text.startswith("P") & days.rlike(r"^([0-9]+[WD])*\z") & clock.rlike(r"^([0-9]+[HMS])*\z")
    return F.when(valid, total(days, "WD") + total(clock, "HMS"))


def strip(text: Column) -> Column:
    """Without white space (any Unicode kind) at both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)^\s+", ""), r"(?U)\s+\z", "")


def video_id(text: Column) -> Column:
    """The id in a watch address, a short address or by itself: 11 characters of A-Z a-z 0-9 _ -; else null."""
    found = (
        F.when(text.contains("v="), F.regexp_extract(text, r"v=([^&#]*)", 1))
        .when(text.contains("youtu.be/"), F.regexp_extract(text, r"youtu\.be/([^?&#]*)", 1)).otherwise(text)
    )
    return F.when(found.rlike(r"^[A-Za-z0-9_-]{11}\z"), found)


def _any(text: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return out


def failure_class(stderr: Column) -> Column:
    """proxy_error, bot_check, unavailable or failed, in this order of precedence."""
    low = F.lower(stderr)
    return F.when(_any(low, PROXY_TEXTS), "proxy_error").when(_any(low, BOT_TEXTS), "bot_check").when(_any(low, GONE_TEXTS), "unavailable").otherwise("failed")


def failure_reason(stderr: Column) -> Column:
    """The last line that starts with ERROR:, else the last that is not blank, else "no output"; 300 characters."""
    lines = F.split(stderr, r"\r?\n")
    error = F.try_element_at(F.filter(lines, lambda x: x.startswith("ERROR:")), F.lit(-1))
    some = F.try_element_at(F.filter(lines, lambda x: F.length(strip(x)) > 0), F.lit(-1))
    return F.substring(F.coalesce(error, some, F.lit("no output")), 1, 300)


def is_strike(outcome: Column) -> Column:
    return outcome.isin(*STRIKES)


def redact(text: Column, url: Column, label: Column) -> Column:
    """The proxy's address replaced by its label, and its password by ***."""
    user = F.try_parse_url(url, F.lit("USERINFO"))
    password = F.when(user.contains(":"), F.nullif(F.substr(user, F.instr(user, F.lit(":")) + 1), F.lit("")))
    named = F.replace(text, url, label)
    return F.when(password.isNull(), named).otherwise(F.replace(named, password, F.lit("***")))


def source_class(source: Column) -> Column:
    return F.when(source.startswith("expand:"), "channel expansion").when(source.startswith("search:"), "search").when(source.startswith("channel:"), "seed channels").otherwise(source)


def is_direct(source: Column) -> Column:
    return ~source.startswith("expand:")


def pacific_day(ts_ntz: Column) -> Column:
    """The date in Los Angeles, as text, of a UTC time without zone."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), ts_ntz), "yyyy-MM-dd")


def shard_name(k: Column) -> Column:
    """shard-00042.jsonl; numbers of more than five digits are written out."""
    text = k.cast("string")
    return F.concat(F.lit("shard-"), F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text), F.lit(".jsonl"))


def record_path(video: Column) -> Column:
    return F.concat(F.lit("videos/"), F.substr(video, F.lit(1), F.lit(2)), F.lit("/"), video, F.lit(".json"))


def watch_url(video: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video)


def channel_url(channel: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/channel/"), channel)


def channel_source(kind: Column, channel: Column) -> Column:
    """The source tag of a channel's uploads: channel:<id> for seeds, expand:<id> for others."""
    return F.concat(F.when(kind == "seed", "channel:").otherwise("expand:"), channel)


def search_source(query: Column) -> Column:
    return F.concat(F.lit("search:"), query)


def next_token(body: Column) -> Column:
    """The token of the next page of a list response; null if there is none, an empty one, or no text."""
    token = F.get_json_object(body, "$.nextPageToken")
    quoted = F.from_json(body, "nextPageToken variant")["nextPageToken"]
    return F.when(F.schema_of_variant(quoted) == "STRING", F.nullif(token, F.lit("")))


def json_long(text: Column, path: str) -> Column:
    """A whole number in a JSON text, also one written as a text; null where it is neither or the text is no JSON."""
    return F.try_variant_get(F.try_parse_json(text), path, "string").try_cast("long")


def batch_name(ts_ntz: Column) -> Column:
    """The name of a batch begun at a UTC time, such as 20240131-235959."""
    return F.date_format(ts_ntz, "yyyyMMdd-HHmmss")


def rfc3339(ts_ntz: Column) -> Column:
    """A UTC time to the second, with its offset."""
    return F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
