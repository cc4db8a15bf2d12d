"""The frontier as sets: first sightings, priority order, one-hop expansion, channels and searches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.positions import with_position
from millrace.functions.scalars import is_direct, source_class


def first_seen(sightings: DataFrame) -> DataFrame:
    """sightings(id, source, call, pos) -> (id, source, seq): the first source of each id by (call, pos).

    seq numbers the ids by the call that brought them, then by id, as one call adds its ids in id order. The first
    row of an id is a minimum over structs, so a frequent id is combined before the shuffle.
    """
    first = sightings.groupBy("id").agg(F.min(F.struct("call", "pos", "source")).alias("first"))
    return with_position(first.select("id", F.col("first.source").alias("source"), F.col("first.call").alias("call")), "call", "id", name="seq").drop("call")


def add_new(known: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``found`` whose key ``known`` does not hold."""
    return found.join(known.select(key), key, "left_anti")


def by_priority(videos: DataFrame, limit: int | None = None) -> DataFrame:
    """The first ``limit`` videos (all without one), direct hits before expansion hits, then by seq; plus their place (from 0)."""
    if limit is None:
        return with_position(videos.withColumn("_expanded", ~is_direct(F.col("source"))), "_expanded", "seq", name="place").drop("_expanded")
    top = videos.orderBy((~is_direct(F.col("source"))).asc(), F.col("seq").asc()).limit(limit)
    order = Window.orderBy((~is_direct(F.col("source"))).asc(), F.col("seq").asc())  # over the few rows of the limit
    return top.withColumn("place", (F.row_number().over(order) - 1).cast("long"))


def unplanned(videos: DataFrame) -> DataFrame:
    """Accepted videos in no batch and without a final state."""
    return videos.filter("status = 'accepted' AND batch IS NULL AND fetch_state IS NULL")


def unchecked(videos: DataFrame, limit: int | None = None) -> DataFrame:
    """Videos that no check has seen yet (status new), the first ``limit`` by seq; all without a limit."""
    new = videos.filter("status = 'new'")
    return new if limit is None else new.orderBy("seq").limit(limit)


def find_channels(wanted: DataFrame, responses: DataFrame) -> DataFrame:
    """wanted(channel) -> (channel, resolved, uploads, note): what the lookup of a handle (@name) or id gave.

    responses(handle, id, pos, uploads): the items of all lookups. The first item (by pos) of its handle answers a
    handle, that of its id an id; without one, or if it lacks its id or uploads, the channel is "not found".
    """
    by = F.explode(F.array("handle", "id")).alias("channel")
    items = responses.select(by, "id", "uploads", "pos").filter("channel IS NOT NULL")
    first = items.groupBy("channel").agg(F.min_by(F.struct("id", "uploads"), F.struct("pos", "id", "uploads")).alias("f"))
    whole = F.col("f.id").isNotNull() & F.col("f.uploads").isNotNull()
    out = wanted.select("channel").distinct().join(first, "channel", "left")
    return out.select("channel", F.when(whole, F.col("f.id")).alias("resolved"), F.when(whole, F.col("f.uploads")).alias("uploads"), F.when(~F.coalesce(whole, F.lit(False)), "not found").alias("note"))


def expand_hop(checked: DataFrame, uploads: DataFrame) -> DataFrame:
    """(id, source) of uploads(channel_id, id) of the channels of accepted direct videos that are not known yet.

    One hop: what expansion brings in does not expand again, as its source is not direct.
    """
    roots = checked.filter((F.col("status") == "accepted") & is_direct(F.col("source")) & (F.col("channel_id") != ""))
    channels = roots.select("channel_id").distinct()
    return add_new(checked, uploads.join(channels, "channel_id", "left_semi").select("id", F.concat(F.lit("expand:"), "channel_id").alias("source"))).groupBy("id").agg(F.min("source").alias("source"))


def add_channels(channels: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted channels that are neither listed nor what a listed handle resolved to."""
    fresh = wanted.join(channels.select("channel"), "channel", "left_anti")
    resolved = channels.filter("resolved IS NOT NULL").select(F.col("resolved").alias("channel"))
    return fresh.join(resolved, "channel", "left_anti")


def collapse_aliases(channels: DataFrame) -> DataFrame:
    """channels plus note: rows without uploads whose channel a row with uploads has resolved are done, "same as" it.

    Of several such rows the one first listed (by seq) is named.
    """
    owner = channels.filter("uploads IS NOT NULL").groupBy(F.col("resolved").alias("target")).agg(F.min(F.struct("seq", "channel")).alias("owner"))
    target = F.coalesce(F.col("resolved"), F.col("channel"))
    out = channels.withColumn("target", target).join(owner, "target", "left")
    same = F.col("owner").isNotNull() & (F.col("owner.channel") != F.col("channel")) & ~F.col("done") & F.col("uploads").isNull()
    return out.select("channel", "seq", "kind", "resolved", "uploads", (F.col("done") | F.coalesce(same, F.lit(False))).alias("done"), F.when(same, F.concat(F.lit("same as "), "owner.channel")).alias("note"))


def next_channels(channels: DataFrame, limit: int) -> DataFrame:
    """Channels that are not done, seeds first, then by seq."""
    return channels.filter("NOT done").orderBy((F.col("kind") != "seed").asc(), F.col("seq").asc()).limit(limit)


def pending_searches(queries: DataFrame, searches: DataFrame) -> DataFrame:
    """queries(list of texts) in their order, with the searches that are not done."""
    return pending_listed(queries.select(F.posexplode("queries").alias("place", "query")), searches)


def pending_listed(listed: DataFrame, searches: DataFrame) -> DataFrame:
    """listed(place, query), of any length, with the searches that are not done. A query that has no row in ``searches``
    is new, so it is pending, with 0 pages where searches have pages and without a next page."""
    new = {"done": F.lit(False), "pages": F.lit(0)}
    out = listed.join(searches, "query", "left")
    return out.withColumns({c: F.coalesce(c, new[c].cast(searches.schema[c].dataType)) for c in new if c in searches.columns}).filter("NOT done")


def gone(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """Requested ids that no response holds."""
    return requested.select("id").distinct().join(returned.select("id"), "id", "left_anti")


def batches(videos: DataFrame, size: int, order: str = "seq") -> DataFrame:
    """videos plus batch_no and place in it, ``size`` at a time in the given order."""
    out = with_position(videos, order)
    return out.withColumn("batch_no", F.floor(F.col("pos") / size).cast("long")).withColumn("place", F.pmod("pos", F.lit(size)).cast("long")).drop("pos")


def counts(videos: DataFrame, searches: DataFrame, channels: DataFrame) -> DataFrame:
    """(what, n): videos by status, accepted by source class, waiting, rejected by class, searches, channels, in this order
    and each part by name."""
    accepted, rejected, waiting = F.col("status") == "accepted", F.col("status") == "rejected", "accepted, not planned or queued-done"
    said = lambda part, what, when=F.lit(True): F.when(when, F.struct(F.lit(part).alias("part"), what.alias("what"), F.lit(1).alias("n")))
    of_video = F.array(
        said(0, F.concat(F.lit("videos "), "status")), said(1, F.concat(F.lit("accepted from "), source_class(F.col("source"))), accepted),
        said(2, F.lit(waiting), accepted & F.col("batch").isNull() & F.col("fetch_state").isNull()), said(3, F.concat(F.lit("rejected: "), F.split_part("reason", F.lit(":"), F.lit(1))), rejected),
    )
    parts = [
        videos.select(F.inline(F.array_compact(of_video))),  # each video is read once
        videos.sparkSession.createDataFrame([(2, waiting, 0)], "part int, what string, n int"),
        searches.select(F.lit(4).alias("part"), F.concat(F.lit("searches "), F.when(F.col("done"), "done").otherwise("pending")).alias("what"), F.lit(1).alias("n")),
        channels.select(F.lit(5).alias("part"), F.concat(F.lit("channels "), "kind", F.when(F.col("done"), " done").otherwise(" pending")).alias("what"), F.lit(1).alias("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("part", "what").agg(F.sum("n").cast("long").alias("n")).orderBy("part", "what").drop("part")  # a few rows
