"""Leases, pages and budgets in depth, and operators whose one key holds half of all rows."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.config import Fetch
from millrace.operators import budget, frontier, health, paging, queue, shred

S, HOUR = 1_000_000, 3_600_000_000
LOG = "id long, ts_us long, worker string, label string, provider string, video string, outcome string"


@pytest.fixture(autouse=True)
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="module")
def busy_log(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        label = "p/busy" if i % 2 else f"p/{rng.randrange(30)}"
        rows.append((i, rng.randrange(2000) * 30 * S, "w", label, "p", "v", rng.choice(["bot_check", "proxy_error", "fetched", "failed", "reset", "unavailable", "bot_check"])))
    return rows, spark.createDataFrame(rows, LOG)


def by_label(rows):
    logs = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        logs[r[3]].append(r)
    return logs


def test_streaks_and_health_of_a_busy_label(busy_log):
    rows, df = busy_log
    streaks, health_ = {}, {}
    for label, log in by_label(rows).items():
        run = peak = last = rest = 0
        retired = False
        for i, ts, *_, outcome in log:
            run = run + 1 if outcome in ("bot_check", "proxy_error") else 0
            if outcome == "reset":
                peak, retired = 0, False
            peak, retired, last = max(peak, run), retired or run >= 3, ts
            rest = ts + 300 * 2 ** (run - 1) * S if 0 < run < 3 else None
            streaks[i] = run
        health_[label] = (run, peak, retired, rest, last)
    assert {r.id: r.streak for r in health.strike_streaks(df).collect()} == streaks
    got = health.ip_health(df, Fetch(bot_check_limit=3, bot_check_backoff_s=300, bot_check_backoff_max_s=86_400)).collect()
    assert {r.label: (r.strikes, r.peak, r.retired, r.rest_until_us, r.last_used_us) for r in got} == health_


def test_load_of_a_busy_label(busy_log):
    rows, df = busy_log
    want = {r[0]: sum(r[1] - HOUR < o[1] <= r[1] for o in log) for log in by_label(rows).values() for r in log}
    assert {r.id: r.load for r in health.hourly_load(df).collect()} == want


def test_a_busy_day_and_a_busy_channel(spark):
    rng = random.Random(3)
    ledger = [(i, "busy" if i % 2 else f"d{i % 9}", rng.choice([1, 100]), rng.choice(["", "", "", "quotaExceeded"]) if i % 40 == 8 else "") for i in range(1200)]
    df = spark.createDataFrame(ledger, "id long, day string, cost int, reason string")
    for quota, reason in ((900, None), (10**9, "reason")):
        want = {}
        for day in {x[1] for x in ledger}:
            used = allowed = 0
            refused, told = None, False
            running = 0
            for i, d, cost, why in ledger:
                if d != day:
                    continue
                running += cost
                if running <= quota and not told:
                    allowed, used = allowed + 1, running
                else:
                    refused = i if refused is None else refused
                told = told or (reason is not None and why == "quotaExceeded")
            want[day] = (allowed, used, refused)
        assert {r.day: (r.allowed, r.used, r.refused_at) for r in budget.quota_guard(df, quota, reason).collect()} == want
    pages = [("busy" if p % 2 else f"c{p % 11}", p, rng.randrange(50)) for p in range(1000)]
    kept, found = set(), Counter()
    for channel, page, n in pages:
        if found[channel] < 300:
            kept.add((channel, page, found[channel]))
        found[channel] += n
    got = budget.upload_cap(spark.createDataFrame(pages, "channel string, page long, n long"), 300).collect()
    assert {(r.channel, r.page, r.found_before) for r in got} == kept


def pool(spark, labels, ips=(), leases=()):
    return (
        spark.createDataFrame(labels, "pool string, label string"), spark.createDataFrame(list(ips), "label string, retired boolean, rest_until_us long, last_used_us long"),
        spark.createDataFrame(list(leases), "label string, lease_until_us long"),
    )


def test_many_leases_at_once(spark):
    """No label goes to two workers, though pools share some; who came first gets the one that rested longest."""
    now = 100 * HOUR
    labels = [("a", "l1"), ("a", "l2"), ("a", "l3"), ("b", "l3"), ("b", "l4"), ("b", "l4"), ("c", "r1"), ("d", "l5"), ("z", "l6")]
    ips = [("l1", False, None, 50), ("l3", False, now, 20), ("l4", False, now + 3 * S, 10), ("r1", True, None, 1), ("l5", False, None, 5)]
    listed, health_, leases = pool(spark, labels, ips, [("l5", now)])
    attempts = spark.createDataFrame([(i, now - i, "w", "l2", "p", "v", "fetched") for i in range(3)], LOG)
    waiting = spark.createDataFrame([("a", "w2", 7), ("a", "w1", 7), ("a", "w3", 1), ("a", "w4", 9), ("b", "w5", 0), ("c", "w6", 0), ("d", "w7", 0), ("none", "w8", 0)], "pool string, worker string, since_us long")
    out = {r.worker: (r.outcome, r.label, r.lease_until_us, r.wait_s) for r in health.ip_leases(listed, health_, leases, attempts, waiting, now, 4, 60).collect()}
    took = lambda label: ("take", label, now + 60 * S, None)
    assert out == {"w3": took("l2"), "w1": took("l3"), "w2": took("l1"), "w4": ("wait", None, None, 5.0), "w5": ("wait", None, None, 3.0), "w6": ("all_retired", None, None, None), "w7": ("wait", None, None, 5.0), "w8": ("all_retired", None, None, None)}
    capped = health.ip_leases(listed, health_, leases, attempts, waiting, now, 3, 60).filter("outcome = 'take'").collect()
    assert {(r.worker, r.label) for r in capped} == {("w3", "l3"), ("w1", "l1")}


def test_many_workers_at_one_pool(spark):
    labels = [("big", f"l{i:04d}") for i in range(700)] + [(f"s{i % 20}", f"m{i}") for i in range(300)]
    waiting = [("big", f"w{i:04d}", i * 37 % 900) for i in range(900)] + [(f"s{i % 20}", f"w{i}", i) for i in range(200)]
    listed, ips, leases = pool(spark, labels, [(f"l{i:04d}", i % 5 == 0, None, i * 53 % 701) for i in range(600)])
    out = health.ip_leases(listed, ips, leases, spark.createDataFrame([], LOG), spark.createDataFrame(waiting, "pool string, worker string, since_us long"), 0, 0).collect()
    taken = [r.label for r in out if r.label]
    assert len(out) == 1100 and len(set(taken)) == len(taken) == 580 + 200
    free = [f"l{i:04d}" for i in range(600, 700)] + [f"l{i:04d}" for i in sorted((i for i in range(600) if i % 5), key=lambda i: (i * 53 % 701, i))]
    queue_ = sorted((x for x in waiting if x[0] == "big"), key=lambda x: (x[2], x[1]))
    assert {r.worker: r.label for r in out if r.pool == "big" and r.label} == dict(zip((x[1] for x in queue_), free, strict=False))


def test_waits_of_a_worker_s_own_pool(spark):
    now, cap = 50 * HOUR, 2
    labels = [("take", "t1"), ("take", "t2"), ("take", "t3"), ("capped", "c1"), ("capped", "c2"), ("rest", "c1"), ("rest", "r1"), ("held", "h1"), ("gone", "g1"), ("edge", "e1")]
    ips = [("t1", False, None, 5), ("t2", False, now, 3), ("r1", False, now + 9 * S, 1), ("g1", True, None, 1), ("c2", False, now + HOUR, 1), ("h1", False, now + 1, 0), ("t3", True, None, 0)]
    listed, health_, _ = pool(spark, labels, ips)
    starts = [("c1", now - 10 * S), ("c1", now - 20 * S), ("c1", now - 30 * S), ("c2", now - 5), ("c2", now - 6), ("e1", now - HOUR), ("e1", now - 1), ("c1", now - 2 * HOUR), ("c1", now + 1)]
    starts = spark.createDataFrame(starts, "label string, start_us long").repartition(4)
    busy = spark.createDataFrame([("h1",), ("h1",)], "label string")
    run = lambda cap: {r.pool: (r.outcome, r.label, r.wait_until_us) for r in health.ip_wait_capped(listed, health_, busy, starts, now, cap).collect()}
    assert run(cap) == {
        "take": ("take", "t2", None), "capped": ("wait", None, now - 20 * S + HOUR), "rest": ("wait", None, now + 9 * S), "held": ("wait", None, None), "gone": ("all_retired", None, None), "edge": ("take", "e1", None),
    }
    assert run(0)["capped"] == ("take", "c1", None)
    latest = {r.label: (r.load, r.full_since_us) for r in health.latest_starts(starts, now, cap).collect()}
    assert latest == {"c1": (3, now - 20 * S), "c2": (2, now - 6), "e1": (1, None)}


def test_double_leases(spark):
    rng = random.Random(4)
    rows = [(i, "busy" if i % 2 else f"l{i % 13}", s := rng.randrange(4000), s + rng.choice([0, 1, 5, 30, 300])) for i in range(900)]
    want = {}
    for label in {r[1] for r in rows}:
        log = sorted((r for r in rows if r[1] == label), key=lambda r: (r[2], r[3], r[0]))
        for k, (i, _, start, end) in enumerate(log):
            held = max(((e, j) for j, _, _, e in log[:k]), default=None)
            if held and held[0] > start:
                want[i] = (held[1], held[0], min(end, held[0]) - start)
    got = health.overlapping_leases(spark.createDataFrame(rows, "id long, label string, start_us long, end_us long")).collect()
    assert {r.id: (r.held_by, r.held_until_us, r.overlap_us) for r in got} == want and want


EVENTS = "video string, at_us long, eid long, kind string, worker string, hold_s int, state string, bytes long"


def test_attempts_within_leases(spark):
    event = lambda video, at, eid, kind, worker, hold=30: (video, at * S, eid, kind, worker, hold, None, 0)
    events = [
        event("a", 0, 1, "lease", "w1"), event("a", 20, 2, "extend", "w1"), event("a", 21, 3, "extend", "w2", 900), event("a", 40, 4, "finish", "w1", 0),  # another's renewal counts for nothing
        event("b", 0, 5, "lease", "w1"), event("b", 10, 6, "requeue", "w2", 5), event("b", 12, 7, "requeue", "w1", 5), event("b", 13, 8, "extend", "w1", 900), event("b", 20, 9, "lease", "w2"),
        event("c", 0, 10, "lease", "w1"), event("c", 10, 11, "lease", "w2"), event("d", 0, 12, "lease", "w1"), event("d", 100, 13, "lease", "w1", 500), event("e", 5, 14, "requeue", "w1", 5),
    ]
    tried = [
        (1, 5, "w1", "a", "bot_check"), (2, 6, "w1", "a", "failed"), (3, 7, "w2", "a", "failed"), (4, 40, "w1", "a", "fetched"), (5, 41, "w1", "a", "fetched"), (6, 12, "w1", "b", "failed"), (7, 14, "w1", "b", "failed"),
        (8, 25, "w2", "b", "proxy_error"), (9, 9, "w1", "c", "failed"), (10, 11, "w1", "c", "failed"), (11, 31, "w1", "d", "failed"), (12, 30, "w1", "d", "failed"), (13, 130, "w1", "d", "bot_check"), (14, 1, "w1", "x", "failed"),
    ]
    log = spark.createDataFrame([(i, t * S, w, "l", "p", v, o) for i, t, w, v, o in tried], LOG)
    out = {r.lease_id: (r.video, r.worker, r.until_us // S, r.ended_us and r.ended_us // S, r.renewals, r.tries, r.strikes, r.state) for r in queue.lease_attempts(spark.createDataFrame(events, EVENTS), log, 200 * S).collect()}
    assert out == {
        1: ("a", "w1", 50, 40, 1, 2, 1, "finished"), 5: ("b", "w1", 913, 12, 1, 1, 0, "requeued"), 9: ("b", "w2", 50, None, 0, 0, 1, "ran_out"), 10: ("c", "w1", 30, None, 0, 1, 0, "replaced"),
        11: ("c", "w2", 40, None, 0, 0, 0, "ran_out"), 12: ("d", "w1", 30, None, 0, 1, 0, "ran_out"), 13: ("d", "w1", 600, None, 0, 0, 1, "open"),
    }
    assert queue.lease_attempts(spark.createDataFrame([], EVENTS), log, 0).count() == 0


def test_quota_of_the_run_s_day(spark):
    """Pacific midnight is 08:00 UTC in January; a run that goes on past it charges the day on which it began."""
    at = lambda t: F.to_timestamp_ntz(F.lit(f"2024-01-{t}"))
    times = ["04 02:00:00", "05 07:59:00", "05 08:30:00", "05 09:00:00", "05 20:00:00", "06 08:00:00"]
    calls = spark.range(len(times)).select("id", F.element_at(F.array(*map(at, times)), (F.col("id") + 1).cast("int")).alias("at"), F.when(F.col("id") % 2 == 0, 100).otherwise(1).alias("cost"), (F.col("id") % 2 == 0).alias("search"))
    runs = spark.range(1).select(F.explode(F.array(at("05 07:00:00"), at("05 09:00:00"), at("05 09:00:00"))).alias("at"))
    got = {tuple(r) for r in budget.quota_by_run_day(calls, runs).collect()}
    assert got == {("2024-01-03", 100, 100, 1, 0), ("2024-01-04", 101, 100, 2, 1), ("2024-01-05", 102, 100, 3, 1)}
    none = {tuple(r)[:2] for r in budget.quota_by_run_day(calls, runs.limit(0)).collect()}
    assert none == {("2024-01-03", 100), ("2024-01-04", 1), ("2024-01-05", 201), ("2024-01-06", 1)}


def test_labels_with_equal_beginnings(spark):
    urls = ["http://u@h:8080", "http://v@h:80", "http://w@h:80", "http://h:801", "http://x@h:80", "http://y@h:808", "http://z@hh:80", "socks5://q@h", "http://r@h:1080", "http://s@[::1]:8", "http://t@[::1]:80", "http://w@[::1]:8"]
    lines = [f"n {u}" for u in urls]
    out = shred.proxies(spark.createDataFrame(list(enumerate(lines, 1)), "line_no long, line string")).orderBy("line_no").collect()
    labels = []
    for line, u in zip(lines, urls, strict=True):
        place = "n/" + u.split("//")[1].split("@")[-1] + (":1080" if u.endswith("@h") else "")
        labels.append(f"{place}#{sum(x.startswith(place) for x in labels) + 1}" if "@" in u else place)
        assert line
    assert [r.label for r in out] == labels and labels[:3] == ["n/h:8080#1", "n/h:80#2", "n/h:80#3"]


def test_a_busy_exit(spark):
    lines = [(i, f"one http://u{i}:p@exit.test:{(88, 8)[i % 2]}") for i in range(1500)] + [(1500 + i, f"r{i}.test" if i % 2 else f"http://r{i}.test") for i in range(100)]
    out = {r.line_no: r.label for r in shred.proxies(spark.createDataFrame(lines, "line_no long, line string")).collect()}
    eights = itertools.count(1)
    assert all(out[i] == f"one/exit.test:{(88, 8)[i % 2]}#{i + 1 if i % 2 else next(eights)}" for i in range(1500))


def test_new_searches_are_pending(spark):
    listed = spark.createDataFrame([(0, "old"), (1, "new"), (2, "over")], "place int, query string")
    known = spark.createDataFrame([("old", 3, "t", False), ("over", 5, None, True), ("unlisted", 0, None, False)], "query string, pages long, next string, done boolean")
    assert {tuple(r) for r in frontier.pending_listed(listed, known).select("place", "query", "pages", "next").collect()} == {(0, "old", 3, "t"), (1, "new", 0, None)}
    assert frontier.pending_listed(listed, known.limit(0)).count() == 3
    assert {r["query"] for r in frontier.pending_listed(listed, known.select("query", "done")).collect()} == {"old", "new"}


def test_page_order(spark):
    rows = [("long", i, f"t{i}" if i else None, f"t{i + 1}" if i < 999 else None) for i in range(1000)]
    rows += [("gap", 5000 + i, f"t{i}" if i else None, f"t{i + 1}") for i in range(9) if i != 4]
    rows += [("circle", 6000 + i, f"t{i}", f"t{(i + 1) % 3}") for i in range(3)] + [("circle", 6010, "t9", None)]
    rows += [("twice", 7000, None, "a"), ("twice", 7001, "a", "b"), ("twice", 7002, "a", "c"), ("twice", 7003, "b", None), ("twice", 7004, "c", None), ("twice", 7005, None, "b"), (None, 8000, None, "n"), (None, 8001, "n", None)]
    random.Random(5).shuffle(rows)
    out = {r.id: (r.page, r.head, r.state) for r in paging.page_chain(spark.createDataFrame(rows, "query string, id long, token string, next string")).collect()}
    assert len(out) == len(rows) and all(out[i] == (i, 0, "whole") for i in range(1000))
    assert [out[5000 + i] for i in (0, 3, 5, 8)] == [(0, 5000, "whole"), (3, 5000, "whole"), (0, 5005, "broken"), (3, 5005, "broken")]
    assert out[6000] == out[6002] == (None, None, "circular") and out[6010] == (0, 6010, "broken")
    assert [out[7000 + i] for i in range(6)] == [(0, 7000, "whole"), (1, 7000, "whole"), (1, 7000, "repeated"), (2, 7000, "whole"), (0, 7004, "broken"), (0, 7000, "repeated")]
    assert out[8001] == (1, 8000, "whole")
    assert paging.page_chain(spark.createDataFrame([], "query string, id long, token string, next string")).count() == 0


def test_a_broken_body_is_an_error(spark):
    rows = [(200, "{", 0), (200, None, 0), (200, "[]", 0), (404, "{", 0)]
    assert [r.outcome for r in budget.api_outcomes(spark.createDataFrame(rows, "status int, body string, attempt int")).collect()] == ["error", "error", "ok", "empty"]
