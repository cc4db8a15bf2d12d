"""The work queue as a fold over its event log, and as predicates over the folded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.carried import Fold, carried
from millrace.functions.scalars import is_direct, is_strike, json_long

SECOND_US = 1_000_000


def _valid(events: DataFrame) -> DataFrame:
    """events plus owner (who holds the lease at each) and live: extend and requeue count only from the owner."""
    order = Window.partitionBy("video").orderBy("at_us", "eid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = F.last(F.when(F.col("kind").isin("lease", "finish", "requeue"), F.struct(F.when(F.col("kind") == "lease", F.col("worker")).alias("worker"))), ignorenulls=True)
    before = Window.partitionBy("video").orderBy("at_us", "eid").rowsBetween(Window.unboundedPreceding, -1)
    held = owner.over(before)["worker"]
    out = events.withColumn("owner", held).withColumn("live", F.col("kind").isin("lease", "finish") | held.eqNullSafe(F.col("worker")))
    return out.withColumn("lease_no", F.count(F.when(F.col("kind") == "lease", 1)).over(order))


def queue_state(events: DataFrame) -> DataFrame:
    """Per video: leases taken, final state and bytes (last finish wins), lease_owner and lease_until_us.

    events(video, at_us, eid, kind, worker, hold_s, state, bytes). A lease or its renewal holds until at + hold; a
    requeue frees the owner and holds the video back until at + delay (0 where the worker stopped: free at once); a
    finish clears both. One window per video.
    """
    live = _valid(events).filter("live")
    me = F.struct("at_us", "eid")
    until = F.col("at_us") + F.col("hold_s") * SECOND_US
    last = F.max_by(F.struct("kind", "worker", until.alias("until")), me).alias("last")
    final = F.max_by(F.struct("state", "bytes", "at_us"), F.when(F.col("kind") == "finish", me)).alias("final")
    out = live.groupBy("video").agg(F.count_if(F.col("kind") == "lease").alias("attempts"), last, final)
    open_ = F.col("last.kind") != "finish"
    return out.select(
        "video", "attempts", F.col("final.state").alias("fetch_state"), F.coalesce("final.bytes", F.lit(0)).cast("long").alias("bytes"), F.col("final.at_us").alias("fetched_us"),
        F.when(F.col("last.kind").isin("lease", "extend"), F.col("last.worker")).alias("lease_owner"), F.when(open_, F.col("last.until")).alias("lease_until_us"),
    )


def lease_intervals(events: DataFrame) -> DataFrame:
    """Per lease: its start, how long it held with its renewals, and when it ended early, if it did."""
    rows = _valid(events).filter("live AND lease_no > 0")
    holds = F.col("kind").isin("lease", "extend")
    out = rows.groupBy("video", "lease_no").agg(
        F.min(F.when(F.col("kind") == "lease", F.col("at_us"))).alias("start_us"),
        F.max(F.when(holds, F.col("at_us") + F.col("hold_s") * SECOND_US)).alias("until_us"),
        F.min(F.when(~holds, F.col("at_us"))).alias("ended_us"), F.count_if(F.col("kind") == "extend").alias("renewals"),
    )
    return out


def lease_attempts(events: DataFrame, attempts: DataFrame, as_of_us: int) -> DataFrame:
    """Per lease: lease_id, video, worker, start_us, until_us, ended_us, renewals, tries, strikes, state.

    attempts(video, ts_us, id, worker, outcome). An attempt is part of a lease if the lease's worker made it while the lease was
    the video's latest and neither answered nor run out; strikes are retried within a lease and are no tries. state: "finished"
    or "requeued" by an answer, "replaced" by the next lease before it had run out, "ran_out" unanswered at ``as_of_us``, "open".

    Both logs are merged in one order (at one moment leases and renewals, attempts, then answers), in which the open lease is
    carried forward; nothing is joined on a range of time, and one video may have any share of both logs.
    """
    rank = F.when(F.col("kind").isin("lease", "extend"), 0).otherwise(2)
    log = events.select("video", F.col("at_us").alias("at"), rank.alias("rank"), F.col("eid").alias("row"), "kind", "worker", (F.col("at_us") + F.col("hold_s") * SECOND_US).alias("until"), F.lit(False).alias("strike"))
    tried = attempts.select("video", F.col("ts_us").alias("at"), F.lit(1).alias("rank"), F.col("id").alias("row"), F.lit("attempt").alias("kind"), "worker", F.lit(None).cast("long").alias("until"), is_strike(F.col("outcome")).alias("strike"))
    holder = F.when(F.col("kind") == "lease", F.struct(F.col("row").alias("lease_id"), F.col("worker").alias("owner"))).when(F.col("kind") == "finish", F.struct(F.lit(None).cast("long").alias("lease_id"), F.lit(None).cast("string").alias("owner")))
    rows = carried(log.unionByName(tried), ("video",), ("at", "rank", "row"), lease=Fold("last", holder, before=True))
    mine = F.col("lease.lease_id").isNotNull() & F.when(F.col("kind").isin("lease", "finish"), F.lit(True)).otherwise(F.col("lease.owner").eqNullSafe(F.col("worker")))
    during = rows.filter(mine).select(F.col("lease.lease_id").alias("lease_id"), "at", "kind", "until", "strike")
    during = during.withColumn("kind", F.when(F.col("kind") == "lease", "next").otherwise(F.col("kind")))
    began = rows.filter("kind = 'lease'").select(F.col("row").alias("lease_id"), "video", "worker", F.col("at").alias("start_us"), F.col("until").alias("first_until"))
    answer = F.when(F.col("kind").isin("finish", "requeue"), F.struct("at", "kind"))
    facts = during.filter("kind <> 'attempt'").groupBy("lease_id").agg(F.min(answer).alias("answer"), F.max(F.when(F.col("kind") == "extend", F.col("until"))).alias("renewed"), F.count_if(F.col("kind") == "extend").alias("renewals"), F.min(F.when(F.col("kind") == "next", F.col("at"))).alias("next"))
    leases = began.join(facts, "lease_id", "left").withColumn("until_us", F.greatest("first_until", "renewed")).withColumn("ended_us", F.col("answer.at"))
    within = during.filter("kind = 'attempt'").join(leases.select("lease_id", F.least("until_us", "ended_us").alias("last")), "lease_id").filter(F.col("at") <= F.col("last"))
    tries = within.groupBy("lease_id").agg(F.count_if(~F.col("strike")).alias("tries"), F.count_if("strike").alias("strikes"))
    state = (
        F.when(F.col("answer.kind") == "finish", "finished").when(F.col("answer.kind") == "requeue", "requeued").when(F.col("next") <= F.col("until_us"), "replaced")
        .when(F.col("until_us") < as_of_us, "ran_out").otherwise("open")
    )
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return leases.join(tries, "lease_id", "left").select("lease_id", "video", "worker", "start_us", "until_us", "ended_us", number("renewals"), number("tries"), number("strikes"), state.alias("state"))


def leasable(videos: DataFrame, state: DataFrame, as_of_us: int) -> DataFrame:
    """Accepted videos in no batch, without a final state, whose lease (if any) has run out at ``as_of_us``."""
    out = videos.join(state.withColumnRenamed("video", "id").select("id", "attempts", F.col("fetch_state").alias("_state"), "lease_until_us"), "id", "left")
    free = F.col("lease_until_us").isNull() | (F.col("lease_until_us") < as_of_us)
    out = out.filter((F.col("status") == "accepted") & F.col("batch").isNull() & F.col("_state").isNull() & free)
    return out.withColumn("attempts", F.coalesce("attempts", F.lit(0)).cast("long")).drop("_state")


def lease_next(free: DataFrame, limit: int, workers: int, as_of_us: int, lease_s: int) -> DataFrame:
    """The next ``limit`` videos (direct first, then seq) dealt over the workers, attempts + 1, leased from ``as_of_us``;
    given back in the order of seq alone."""
    order = ((~is_direct(F.col("source"))).asc(), F.col("seq").asc())
    top = free.orderBy(*order).limit(limit)
    place = F.row_number().over(Window.orderBy(*order)) - 1  # over the few rows of the limit
    out = top.select("id", "seq", "source", F.pmod(place, F.lit(workers)).cast("long").alias("worker"), (F.col("attempts") + 1).cast("long").alias("attempts"), F.lit(as_of_us + lease_s * SECOND_US).cast("long").alias("lease_until_us"))
    return out.orderBy("seq")


def final_outcomes(videos: DataFrame | None, attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Per video its first final attempt: fetched or unavailable at once, failed at the ``max_attempts``-th try.

    Strikes are retried within a lease and use up no try. videos: those that count (None: all that were tried).
    """
    tries = attempts.filter(~is_strike(F.col("outcome")))
    if videos is not None:
        tries = tries.join(videos.select(F.col("id").alias("video")), "video", "left_semi")
    k = F.row_number().over(Window.partitionBy("video").orderBy("ts_us", "id"))
    final = tries.withColumn("tries", k.cast("long")).filter((F.col("outcome") != "failed") | (F.col("tries") >= max_attempts))
    first = final.groupBy("video").agg(F.min(F.struct("tries", "id", "outcome", "bytes", "duration_s")).alias("f"))
    return first.select(F.col("video").alias("id"), F.col("f.outcome").alias("status"), F.col("f.tries").alias("tries"), F.col("f.bytes").alias("bytes"), F.col("f.duration_s").alias("duration_s"))


def queue_progress(videos: DataFrame, state: DataFrame, as_of_us: int) -> DataFrame:
    """Per state (final, leased or queued; a cooling video counts as leased): videos, bytes, seconds, and how many cool.

    Seconds are the videos' ``duration_s``; where they have a column ``meta`` instead, a JSON text, they are its field of that name
    (none where it is absent or no whole number)."""
    if "duration_s" not in videos.columns:
        videos = videos.withColumn("duration_s", F.coalesce(json_long(F.col("meta"), "$.duration_s"), F.lit(0)))
    rows = videos.filter("status = 'accepted' AND batch IS NULL").join(state.withColumnRenamed("video", "id").select("id", F.col("fetch_state").alias("_state"), F.col("bytes").alias("_bytes"), "lease_owner", "lease_until_us"), "id", "left")
    held = F.coalesce(F.col("lease_until_us") > as_of_us, F.lit(False))
    now = F.coalesce("_state", F.when(held, "leased").otherwise("queued"))
    return rows.groupBy(now.alias("state")).agg(
        F.count(F.lit(1)).alias("videos"), F.sum(F.coalesce("_bytes", F.lit(0))).cast("long").alias("bytes"), F.sum("duration_s").cast("long").alias("seconds"),
        F.count_if(F.col("_state").isNull() & held & F.col("lease_owner").isNull()).alias("cooling"),
    )
