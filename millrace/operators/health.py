"""Worker and address health from the attempt log: streaks, benches, hourly load, picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import Fetch
from millrace.functions.carried import Fold, carried
from millrace.functions.positions import with_sum_since
from millrace.functions.scalars import is_strike

HOUR_US = 3_600_000_000


def _streaked(attempts: DataFrame) -> DataFrame:
    """attempts plus streak and resets: strikes in a row, and reset rows so far, up to each attempt of a label."""
    strike = F.coalesce(is_strike(F.col("outcome")), F.lit(False))
    streak = Fold("since", F.when(strike, 1).otherwise(0), ~strike)
    return carried(attempts, ("label",), ("ts_us", "id"), streak=streak, resets=Fold("sum", F.when(F.col("outcome") == "reset", 1).otherwise(0)))


def strike_streaks(attempts: DataFrame) -> DataFrame:
    """attempts plus streak: strikes in a row per label up to each attempt; any other outcome resets it.

    A reset row (outcome "reset") starts over as well. One label's log may be any share of all attempts.
    """
    return _streaked(attempts).drop("resets")


def _benched(streaked: DataFrame, f: Fetch) -> DataFrame:
    limit = max(f.bot_check_limit, 1)
    top = max(f.bot_check_backoff_max_s, f.bot_check_backoff_s)
    doubled = F.lit(f.bot_check_backoff_s).cast("long") * F.pow(F.lit(2), F.least(F.col("streak") - 1, F.lit(16))).cast("long")
    out = streaked.withColumn("retired", F.col("streak") >= limit)
    return out.withColumn("bench_s", F.when((F.col("streak") > 0) & (F.col("streak") < limit), F.least(doubled, F.lit(top))))


def benches(attempts: DataFrame, f: Fetch = Fetch()) -> DataFrame:
    """strike_streaks plus bench_s and retired: the bench doubles with each strike up to a maximum; at the limit the
    label is retired and not benched."""
    return _benched(strike_streaks(attempts), f)


def ip_health(attempts: DataFrame, f: Fetch = Fetch()) -> DataFrame:
    """Per label: strikes now, peak streak, retired (sticky until a reset row), rest_until_us, last_used_us."""
    seen = _benched(_streaked(attempts.select("label", "provider", "ts_us", "id", "outcome")), f)
    last = F.max_by(F.struct("streak", "bench_s", "ts_us"), F.struct("ts_us", "id")).alias("last")
    since = seen.groupBy("label", "provider", "resets").agg(last, F.max("streak").alias("peak"), F.max("retired").alias("retired"))
    now = F.max_by(F.struct("last", "peak", "retired"), "resets").alias("now")  # after the last reset
    out = since.groupBy("label", "provider").agg(now).select("label", "provider", "now.*")
    rest = F.when(F.col("last.bench_s").isNotNull(), F.col("last.ts_us") + F.col("last.bench_s") * 1_000_000)
    return out.select("label", "provider", F.col("last.streak").alias("strikes"), "peak", "retired", rest.alias("rest_until_us"), F.col("last.ts_us").alias("last_used_us"))


def hourly_load(attempts: DataFrame) -> DataFrame:
    """attempts plus load: attempts of the label that ended in the hour before (excluded) up to this one.

    The difference of two running counts: up to each moment of a label, and up to an hour before it. Both are points in one
    order, so a label with any share of all attempts is no window of its own.
    """
    times = attempts.groupBy("label", "ts_us").agg(F.count(F.lit(1)).alias("n"))
    points = times.select("label", "ts_us", F.explode(F.array(F.lit(False), F.lit(True))).alias("earlier"), "n")
    points = points.select("label", "ts_us", "earlier", (F.col("ts_us") - F.when(F.col("earlier"), HOUR_US).otherwise(0)).alias("at"), F.when(F.col("earlier"), 0).otherwise(F.col("n")).alias("n"))
    counted = carried(points, ("label",), ("at", "earlier"), upto=Fold("sum", F.col("n")))
    load = counted.groupBy(F.col("label").alias("_label"), F.col("ts_us").alias("_ts")).agg(F.sum(F.when(F.col("earlier"), -F.col("upto")).otherwise(F.col("upto"))).alias("load"))
    return attempts.join(load, F.col("label").eqNullSafe(F.col("_label")) & (F.col("ts_us") == F.col("_ts")), "left").drop("_label", "_ts")


def _with_load(ips: DataFrame, attempts: DataFrame, as_of_us: int) -> DataFrame:
    recent = attempts.filter((F.col("ts_us") > as_of_us - HOUR_US) & (F.col("ts_us") <= as_of_us)).groupBy("label").agg(F.count(F.lit(1)).alias("_load"))
    return ips.join(recent, "label", "left").withColumn("load", F.coalesce("_load", F.lit(0)).cast("long")).drop("_load")


def ip_pick(ips: DataFrame, attempts: DataFrame, as_of_us: int, cap: int, limit: int = 1) -> DataFrame:
    """The least recently used labels that may be leased: not retired, rested, under the hourly cap (0: none).

    Never used ones come first; ties go by label.
    """
    rested = F.col("rest_until_us").isNull() | (F.col("rest_until_us") <= as_of_us)
    free = _with_load(ips, attempts, as_of_us).filter(~F.col("retired") & rested)
    if cap > 0:
        free = free.filter(F.col("load") < cap)
    return free.orderBy(F.col("last_used_us").asc_nulls_first(), "label").limit(limit)


def ip_wait(ips: DataFrame, as_of_us: int) -> DataFrame:
    """One row: labels listed, retired and left, and seconds until the first of those has rested (null if none is left)."""
    wait = F.min(F.when(~F.col("retired"), F.greatest(F.coalesce("rest_until_us", F.lit(as_of_us)) - as_of_us, F.lit(0)) / 1e6))
    return ips.agg(F.count(F.lit(1)).alias("listed"), F.count_if("retired").alias("retired"), F.count_if(~F.col("retired")).alias("left"), wait.alias("wait_s"))


def error_stop(attempts: DataFrame, limit: int) -> DataFrame:
    """Per worker the first attempt at which ``limit`` failures in a row had added up; only a fetch resets the count.

    A worker's log may be any share of all attempts, so it is not gathered in one window.
    """
    failed = F.when(F.col("outcome") == "failed", 1).otherwise(0)
    runs = with_sum_since(attempts.select("worker", "ts_us", "id", "outcome"), failed, F.col("outcome") == "fetched", "worker", "ts_us", "id", name="run")
    first = runs.filter(F.col("run") >= limit).groupBy("worker").agg(F.min(F.struct("ts_us", "id", "run")).alias("f"))
    return first.select("worker", F.col("f.id").alias("id"), F.col("f.ts_us").alias("ts_us"), F.col("f.run").alias("run"))


def hourly_starts(leases: DataFrame) -> DataFrame:
    """leases(label, start_us) plus load: leases of the label that began in the hour before (excluded) up to this one.

    A pool of one worker counts the starts of its leases; a shared one counts the ends of attempts (``hourly_load``).
    """
    return hourly_load(leases.withColumn("ts_us", F.col("start_us"))).drop("ts_us")


def _offers(listed: DataFrame, ips: DataFrame, leases: DataFrame, attempts: DataFrame, as_of_us: int, cap: int) -> DataFrame:
    """listed labels with last_used_us, retired, rest (microseconds left, null: rested) and free."""
    held = leases.groupBy("label").agg(F.max("lease_until_us").alias("lease_until_us"))
    rows = listed.select("pool", "label").distinct().join(ips.select("label", "retired", "rest_until_us", "last_used_us"), "label", "left").join(held, "label", "left")
    rows = _with_load(rows, attempts, as_of_us).withColumn("retired", F.coalesce("retired", F.lit(False)))
    rest = F.when(~F.col("retired") & (F.col("rest_until_us") > as_of_us), F.col("rest_until_us") - as_of_us)
    leased = F.coalesce(F.col("lease_until_us") >= as_of_us, F.lit(False))
    free = ~F.col("retired") & rest.isNull() & ~leased
    return rows.select("pool", "label", "last_used_us", "retired", rest.alias("rest"), (free & (F.col("load") < cap) if cap > 0 else free).alias("free"))


def _wait_s(rest: Column) -> Column:
    return F.least(F.greatest(F.coalesce(rest / 1e6, F.lit(5.0)), F.lit(0.2)), F.lit(5.0))


def ip_lease(listed: DataFrame, ips: DataFrame, leases: DataFrame, attempts: DataFrame, as_of_us: int, cap: int, hold_s: int = 3_600) -> DataFrame:
    """What each pool of addresses gives at ``as_of_us``: (pool, outcome, label, lease_until_us, wait_s).

    listed(pool, label): the labels of each pool, used or not. ips: their health (``ip_health``; none: never used).
    leases(label, lease_until_us): the last lease. outcome: "take" with the label to lease, the least recently used one
    (never used ones first, ties by label) that is not retired, has rested, is not leased and is under the hourly cap
    (0: none); "all_retired"; or "wait", wait_s being the seconds until the first label that is not retired has
    rested, but 0.2 at least and 5 at most, as other workers give labels back too.
    """
    rows = _offers(listed, ips, leases, attempts, as_of_us, cap)
    out = rows.groupBy("pool").agg(F.min(F.when(F.col("free"), F.struct("last_used_us", "label"))).alias("pick"), F.min("rest").alias("rest"), F.bool_and("retired").alias("gone"))
    take = F.col("pick").isNotNull()
    outcome = F.when(take, "take").when(F.col("gone"), "all_retired").otherwise("wait")
    return out.select(
        "pool", outcome.alias("outcome"), F.col("pick.label").alias("label"), F.when(take, F.lit(as_of_us + hold_s * 1_000_000)).cast("long").alias("lease_until_us"),
        F.when(outcome == "wait", _wait_s(F.col("rest"))).alias("wait_s"),
    )


def ip_leases(listed: DataFrame, ips: DataFrame, leases: DataFrame, attempts: DataFrame, waiting: DataFrame, as_of_us: int, cap: int, hold_s: int = 3_600) -> DataFrame:
    """What all workers that wait at ``as_of_us`` get: (pool, worker, outcome, label, lease_until_us, wait_s).

    waiting(pool, worker, since_us): who waits, each worker once a pool; the others are as for ``ip_lease``. The k-th of a pool
    to have come (ties by worker) gets its k-th free label, so no label is given twice: one that several pools list is offered
    by the first of them, by name, that anyone waits at. Who gets none is told "all_retired" or how long to wait. A pool
    without labels has none that is not retired. Both ranks are counted over range partitions, not in a window a pool.
    """
    asked = waiting.select("pool").distinct()
    rows = _offers(listed.join(asked, "pool", "left_semi"), ips, leases, attempts, as_of_us, cap)
    offered = rows.filter("free").groupBy("label").agg(F.min("pool").alias("pool"), F.first("last_used_us").alias("last_used_us"))
    offered = carried(offered, ("pool",), ("last_used_us", "label"), place=Fold("sum", F.lit(1))).select("pool", "place", "label")
    queue = carried(waiting.select("pool", "worker", "since_us"), ("pool",), ("since_us", "worker"), place=Fold("sum", F.lit(1)))
    told = rows.groupBy("pool").agg(F.min("rest").alias("rest"), F.bool_and("retired").alias("gone"))
    out = queue.join(offered, ["pool", "place"], "left").join(told, "pool", "left")
    take = F.col("label").isNotNull()
    outcome = F.when(take, "take").when(F.coalesce("gone", F.lit(True)), "all_retired").otherwise("wait")
    return out.select(
        "pool", "worker", outcome.alias("outcome"), "label", F.when(take, F.lit(as_of_us + hold_s * 1_000_000)).cast("long").alias("lease_until_us"),
        F.when(outcome == "wait", _wait_s(F.col("rest"))).alias("wait_s"),
    )


def latest_starts(starts: DataFrame, as_of_us: int, cap: int) -> DataFrame:
    """starts(label, start_us) -> (label, load, full_since_us): starts of the last hour, and the ``cap``-th latest of them.

    The latest few of a label are kept per task before they meet, so a label with very many starts is no large group.
    """
    recent = starts.filter((F.col("start_us") > as_of_us - HOUR_US) & (F.col("start_us") <= as_of_us))
    few = lambda c: F.slice(F.sort_array(c, asc=False), 1, max(cap, 1))
    parts = recent.withColumn("_part", F.spark_partition_id()).groupBy("label", "_part").agg(F.count(F.lit(1)).alias("n"), few(F.collect_list("start_us")).alias("latest"))
    out = parts.groupBy("label").agg(F.sum("n").alias("load"), few(F.flatten(F.collect_list("latest"))).alias("latest"))
    return out.select("label", "load", F.get("latest", F.lit(cap - 1)).alias("full_since_us"))


def ip_wait_capped(listed: DataFrame, ips: DataFrame, busy: DataFrame, starts: DataFrame, as_of_us: int, cap: int) -> DataFrame:
    """What a worker's own pool gives at ``as_of_us``: (pool, outcome, label, wait_until_us).

    listed(pool, label); ips: health of used labels; busy(label): leased now; starts(label, start_us): when leases began. A label
    is free once it has rested and, with ``cap`` starts in the last hour, once the ``cap``-th latest is an hour old. outcome:
    "take" with the least recently used free label (never used ones first, ties by label); else "wait" until the first label
    that is neither retired nor leased comes free (null: not before a lease is given back); "all_retired" if all are.
    """
    rows = listed.select("pool", "label").distinct().join(ips.select("label", "retired", "rest_until_us", "last_used_us"), "label", "left")
    rows = rows.join(busy.select("label", F.lit(True).alias("busy")).distinct(), "label", "left").join(latest_starts(starts, as_of_us, cap), "label", "left")
    gone, capped = F.coalesce("retired", F.lit(False)), F.lit(cap > 0) & F.coalesce(F.col("load") >= cap, F.lit(False))
    free_at = F.coalesce(F.greatest("rest_until_us", F.when(capped, F.col("full_since_us") + HOUR_US)), F.lit(as_of_us))
    open_ = ~gone & F.col("busy").isNull()
    free, later = open_ & (free_at <= as_of_us), F.when(open_ & (free_at > as_of_us), free_at)
    out = rows.groupBy("pool").agg(F.min(F.when(free, F.struct("last_used_us", "label"))).alias("pick"), F.min(later).alias("later"), F.bool_and(gone).alias("gone"))
    outcome = F.when(F.col("gone"), "all_retired").when(F.col("pick").isNotNull(), "take").otherwise("wait")
    return out.select("pool", outcome.alias("outcome"), F.col("pick.label").alias("label"), F.when(outcome == "wait", F.col("later")).alias("wait_until_us"))


def overlapping_leases(leases: DataFrame) -> DataFrame:
    """leases(id, label, start_us, end_us) that began while an earlier one of the label still ran: with held_by and
    held_until_us, the earlier lease that runs longest, and how long both ran (overlap_us).

    A lease whose hold is shorter than its download lets the label be given out again. A sweep in order of the starts with a
    running maximum of the ends; no lease is compared with all others. A lease ends before one that begins at its end.
    """
    ends = Fold("max", F.struct(F.col("end_us").alias("held_until_us"), F.col("id").alias("held_by")), before=True)
    rows = carried(leases.select("id", "label", "start_us", "end_us"), ("label",), ("start_us", "end_us", "id"), _held=ends)
    rows = rows.select("id", "label", "start_us", "end_us", "_held.held_by", "_held.held_until_us").filter(F.col("held_until_us") > F.col("start_us"))
    return rows.withColumn("overlap_us", F.least("end_us", "held_until_us") - F.col("start_us"))
