from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import config
from millrace.config import Fetch, Filters
from millrace.functions import scalars
from millrace.functions.positions import with_position, with_running_sum, with_sum_since
from millrace.operators import admission, budget, frontier, health, planner, queue, report, shred

VIDEO = "id string, seq long, source string, channel_id string, license string, privacy string, live string, age_restricted boolean, made_for_kids boolean, duration_s long"


def video(i, seq=0, source="seed", channel="UC1", **over):
    row = {"id": i, "seq": seq, "source": source, "channel_id": channel, "license": "creativeCommon", "privacy": "public", "live": "none", "age_restricted": False, "made_for_kids": False, "duration_s": 60}
    return tuple((row | over).values())


def test_first_rule_wins_and_switches(spark):
    rows = [video("a"), video("b", license="x", privacy="private"), video("c", privacy="unlisted"), video("d", live="upcoming", age_restricted=True), video("e", age_restricted=True), video("f", made_for_kids=True), video("g", duration_s=9), video("h", duration_s=3600), video("i", privacy="private")]
    df = spark.createDataFrame(rows, VIDEO)
    want = {"a": None, "b": "license:x", "c": None, "d": "live:upcoming", "e": "age_restricted", "f": "made_for_kids", "g": "duration:9", "h": None, "i": "private"}
    assert {r.id: r.reason for r in admission.check(df).collect()} == want
    lax = {r.id: r.reason for r in admission.check(df, Filters(skip_live=False, skip_age_restricted=False, skip_made_for_kids=False)).collect()}
    assert lax["d"] is None and lax["e"] is None and lax["f"] is None


def test_config_rejects_unknown_keys():
    assert config.build(config.Config, {"plan": {"shard_size": 7}}).plan.shard_size == 7
    assert config.build(config.Config, None) == config.Config()
    with pytest.raises(ValueError, match="sharp_size"):
        config.build(config.Config, {"plan": {"sharp_size": 7}})


def test_positions_are_exact(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k")
    got = with_position(df, "k").collect()
    assert all(r.k == r.pos for r in got) and len(got) == 5000
    assert with_position(df.filter("k < 0"), "k").count() == 0


def test_first_seen_and_one_hop(spark):
    seen = spark.createDataFrame([("b", "s1", 0, 0), ("a", "s1", 0, 1), ("a", "s2", 0, 2), ("c", "s3", 1, 0), ("b", "s9", 1, 1)], "id string, source string, call long, pos long")
    assert {(r.id, r.source, r.seq) for r in frontier.first_seen(seen).collect()} == {("a", "s1", 0), ("b", "s1", 1), ("c", "s3", 2)}
    checked = admission.check(spark.createDataFrame([video("s1", 1, "search:q"), video("e1", 2, "expand:UC2", "UC2"), video("r1", 3, "seed", "UC3", license="x")], VIDEO))
    uploads = spark.createDataFrame([("UC1", "new"), ("UC1", "s1"), ("UC2", "far"), ("UC3", "no")], "channel_id string, id string")
    assert [tuple(r) for r in frontier.expand_hop(checked, uploads).collect()] == [("new", "expand:UC1")]


def test_aliases_collapse(spark):
    rows = [("UC1", 1, "seed", "UC1", "UU1", False), ("@one", 2, "seed", "UC1", None, False), ("UC2", 3, "expand", None, None, False)]
    out = {r.channel: (r.done, r.note) for r in frontier.collapse_aliases(spark.createDataFrame(rows, "channel string, seq long, kind string, resolved string, uploads string, done boolean")).collect()}
    assert out == {"UC1": (False, None), "@one": (True, "same as UC1"), "UC2": (False, None)}


def test_shards_and_slots(spark):
    rows = [video(f"v{i:03}", i, "expand:UC1" if i < 2 else "seed") for i in range(12)]
    out = planner.shard_layout(spark.createDataFrame(rows, VIDEO), 5).orderBy("shard", "pos").collect()
    assert [r.id for r in out] == [f"v{i:03}" for i in [*range(2, 12), 0, 1]]
    assert [(r.shard, r.pos) for r in out][-1] == (2, 1) and out[0].file == "shard-00000.jsonl"
    with pytest.raises(ValueError):
        planner.shard_layout(spark.createDataFrame(rows, VIDEO), 0)
    six = spark.createDataFrame([("b0", k) for k in range(6)], "batch string, shard long")
    assert {r.shard for r in planner.slot_assignment(six, 3, 1).filter("rank = 1").collect()} == {1, 4}
    done = spark.createDataFrame([("b0", 1), ("b0", 4)], "batch string, shard long")
    assert {r.shard for r in planner.skip_done_shards(six, done).collect()} == {0, 2, 3, 5}


LOG = "id long, ts_us long, worker string, label string, provider string, video string, outcome string, bytes long, seconds double, duration_s long"


def log(spark, rows):
    return spark.createDataFrame([(i, t, w, lab, lab.split("/")[0], v, o, 10, 1.0, 5) for i, (t, w, lab, v, o) in enumerate(rows)], LOG)


def test_streaks_benches_and_retirement(spark):
    s = 1_000_000
    df = log(spark, [(1 * s, "w", "p/a", "x", "bot_check"), (2 * s, "w", "p/a", "x", "fetched"), (3 * s, "w", "p/a", "x", "proxy_error"), (4 * s, "w", "p/b", "x", "bot_check"), (5 * s, "w", "p/b", "x", "bot_check")])
    f = Fetch(bot_check_limit=2, bot_check_backoff_s=600)
    ips = {r.label: r for r in health.ip_health(df, f).collect()}
    assert (ips["p/a"].strikes, ips["p/a"].retired, ips["p/a"].rest_until_us) == (1, False, 603 * s)
    assert (ips["p/b"].strikes, ips["p/b"].retired, ips["p/b"].rest_until_us) == (2, True, None)
    assert [r.label for r in health.ip_pick(health.ip_health(df, f), df, 700 * s, 0).collect()] == ["p/a"]
    assert health.ip_pick(health.ip_health(df, f), df, 10 * s, 0).count() == 0
    wait = health.ip_wait(health.ip_health(df, f), 3 * s).first()
    assert (wait.listed, wait.retired, wait.left, wait.wait_s) == (2, 1, 1, 600.0)


def test_reset_starts_over(spark):
    df = log(spark, [(1, "w", "p/a", "x", "bot_check"), (2, "w", "p/a", "x", "bot_check"), (3, "w", "p/a", "x", "bot_check"), (4, "w", "p/a", "x", "reset"), (5, "w", "p/a", "x", "bot_check")])
    row = health.ip_health(df).first()
    assert (row.strikes, row.retired, row.peak) == (1, False, 1)


def test_streaks_equal_a_fold(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(500), "w", f"p/{rng.randrange(4)}", "x", rng.choice(["fetched", "failed", "bot_check", "proxy_error"])) for _ in range(600)]
    want, run = {}, {}
    for i, (t, _, lab, _, o) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[0])):
        run[lab] = run.get(lab, 0) + 1 if o in ("bot_check", "proxy_error") else 0
        want[i] = run[lab]
    assert {r.id: r.streak for r in health.strike_streaks(log(spark, rows)).collect()} == want


def test_hourly_load_is_half_open(spark):
    df = log(spark, [(0, "w", "p/a", "x", "fetched"), (health.HOUR_US - 1, "w", "p/a", "x", "fetched"), (health.HOUR_US, "w", "p/a", "x", "fetched")])
    assert [r.load for r in health.hourly_load(df).orderBy("ts_us").collect()] == [1, 2, 2]


def test_error_stop_counts_over_unavailable(spark):
    df = log(spark, [(1, "w1", "p/a", "x", "failed"), (2, "w1", "p/a", "x", "unavailable"), (3, "w1", "p/a", "x", "failed"), (4, "w2", "p/a", "x", "failed"), (5, "w2", "p/a", "x", "fetched"), (6, "w2", "p/a", "x", "failed")])
    assert [(r.worker, r.id) for r in health.error_stop(df, 2).collect()] == [("w1", 2)]


def test_final_outcomes(spark):
    vids = spark.createDataFrame([("f",), ("u",), ("x",), ("open",)], "id string")
    rows = [(1, "w", "p/a", "f", "failed"), (2, "w", "p/a", "f", "bot_check"), (3, "w", "p/a", "f", "fetched"), (4, "w", "p/a", "f", "unavailable"), (5, "w", "p/a", "u", "unavailable"), (6, "w", "p/a", "x", "failed"), (7, "w", "p/a", "x", "failed"), (8, "w", "p/a", "open", "failed")]
    assert {r.id: (r.status, r.tries) for r in queue.final_outcomes(vids, log(spark, rows), 2).collect()} == {"f": ("fetched", 2), "u": ("unavailable", 1), "x": ("failed", 2)}


EVENTS = "video string, at_us long, eid long, kind string, worker string, hold_s int, state string, bytes long"


def test_queue_state_and_leases(spark):
    s = queue.SECOND_US
    rows = [
        ("a", 0, 1, "lease", "w1", 30, None, 0), ("a", 10 * s, 2, "extend", "w2", 900, None, 0), ("a", 20 * s, 3, "extend", "w1", 30, None, 0), ("b", 0, 4, "lease", "w1", 30, None, 0),
        ("b", 5 * s, 5, "requeue", "w1", 600, None, 0), ("c", 0, 6, "lease", "w1", 30, None, 0), ("c", 5 * s, 7, "finish", "w1", 0, "fetched", 9), ("d", 0, 8, "lease", "w1", 30, None, 0), ("d", 40 * s, 9, "lease", "w2", 30, None, 0),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    state = {r.video: (r.attempts, r.fetch_state, r.lease_owner, r.lease_until_us) for r in queue.queue_state(events).collect()}
    assert state == {"a": (1, None, "w1", 50 * s), "b": (1, None, None, 605 * s), "c": (1, "fetched", None, None), "d": (2, None, "w2", 70 * s)}
    vids = admission.check(spark.createDataFrame([video(i, n) for n, i in enumerate("abcde")], VIDEO)).selectExpr("*", "CAST(NULL AS string) AS batch")
    free = queue.leasable(vids, queue.queue_state(events), 60 * s)
    assert {r.id for r in free.collect()} == {"a", "e"}
    nxt = queue.lease_next(free, 2, 2, 60 * s, 30).orderBy("seq").collect()
    assert [(r.id, r.worker, r.attempts) for r in nxt] == [("a", 0, 2), ("e", 1, 1)]
    by = {r.state: (r.videos, r.cooling) for r in queue.queue_progress(vids, queue.queue_state(events), 60 * s).collect()}
    assert by == {"fetched": (1, 0), "leased": (2, 1), "queued": (2, 0)}
    leases = {(r.video, r.lease_no): (r.until_us, r.ended_us, r.renewals) for r in queue.lease_intervals(events).collect()}
    assert leases[("a", 1)] == (50 * s, None, 1) and leases[("b", 1)] == (30 * s, 5 * s, 0)


def test_budgets(spark):
    pages = spark.createDataFrame([("q1", 0, p) for p in range(4)] + [("q2", 1, p) for p in range(4)], "query string, query_pos int, page long")
    assert [(r["query"], r.page) for r in budget.search_budget(pages, 300, 2).orderBy("units").collect()] == [("q1", 0), ("q1", 1), ("q2", 0)]
    ups = spark.createDataFrame([("c", p, 50) for p in range(5)], "channel string, page long, n long")
    assert sum(r.n for r in budget.upload_cap(ups, 120).collect()) == 150
    ledger = spark.createDataFrame([("d", i, c, c == 100) for i, c in enumerate([1, 100, 100, 1])], "day string, id long, cost int, search boolean")
    assert tuple(budget.quota_guard(ledger, 150).first()) == ("d", 2, 101, 2)
    assert tuple(budget.quota_by_day(ledger).first()) == ("d", 202, 200, 4)


def test_api_outcomes(spark):
    body = '{"error": {"errors": [{"reason": "%s"}]}}'
    rows = [(200, "{}", 0), (404, "", 0), (403, body % "quotaExceeded", 0), (403, body % "rateLimitExceeded", 4), (503, "", 5), (None, None, 1), (400, "junk", 0)]
    got = [(r.outcome, r.wait_factor) for r in budget.api_outcomes(spark.createDataFrame(rows, "status int, body string, attempt int")).collect()]
    assert got == [("ok", None), ("empty", None), ("out_of_quota", None), ("retry", 32), ("error", None), ("retry", 4), ("error", None)]


def test_report_arithmetic(spark):
    df = log(spark, [(0, "w", "p/a", "x", "bot_check"), (1, "w", "p/a", "x", "bot_check"), (86_400_000_000, "w", "p/a", "x", "fetched")])
    row = report.provider_report(report.provider_totals(df, health.ip_health(df, Fetch(bot_check_limit=2))), {"p": 30.0}).first()
    assert (row.ips, row.retired, row.tries, round(row.strike_pct, 1)) == (1, 1, 3, 66.7)
    assert row.per_ip_day == 1.0 and round(row.cost_per_hour, 6) == round(1.0 / (15 / 3600), 6)
    bare = report.provider_report(report.provider_totals(df, health.ip_health(df)), {}).first()
    assert bare.cost_per_hour is None


def test_batches(spark):
    b = spark.createDataFrame([("b0", 4, 2), ("b1", 1, 1)], "batch string, videos long, shards long")
    m = spark.createDataFrame([("b0", 0, "fetched", 5, 2), ("b0", 0, "gone?", 9, 9), ("b0", 1, "unavailable", 0, 0)], "batch string, shard long, status string, bytes long, duration_s long")
    out = planner.batch_progress(b, m)
    assert {tuple(r) for r in out.collect()} == {("b0", 4, 2, 2, 1, 1, 1, 5, 2), ("b1", 1, 1, 0, 0, 0, 0, 0, 0)}
    assert planner.batch_total(out).count() == 1 and planner.batch_total(out.filter("batch = 'b0'")).count() == 0


def test_media_pick(spark):
    rows = [("abc", "abc.en.vtt", 1), ("abc", "abc.mp4.part", 8), ("abc", "abc.mp4", 2), ("abc", "other.mp4", 3), ("z", "z.json", 4), ("t", "t.b", 5), ("t", "t.a", 5)]
    got = {r.id: (r.bytes, r.media) for r in report.media_pick(spark.createDataFrame(rows, "id string, name string, bytes long")).collect()}
    assert got == {"abc": (3, "abc.mp4"), "z": (4, None), "t": (10, "t.a")}


def test_lists(spark):
    lines = ["# pool of May", "north https://ann:k9!pw@exit.north.example:8443", "north https://bob:k9!pw@exit.north.example:8443", "", "socks5h://192.0.2.7", "socks5h://192.0.2.7", "gopher://h:1", "no address"]
    out = shred.proxies(spark.createDataFrame(list(enumerate(lines, 1)), "line_no long, line string")).orderBy("line_no").collect()
    assert [r.label for r in out][:3] == ["north/exit.north.example:8443#1", "north/exit.north.example:8443#2", "default/192.0.2.7:1080"]
    assert [r.error for r in out] == [None, None, None, "listed twice", "unsupported scheme", "not a proxy URL"]
    assert "k9!pw" not in str(out)
    ids = spark.createDataFrame([(1, "abcdefghijk"), (2, "# no"), (3, "bad")], "line_no long, line string")
    assert [(r.line_no, r.ok) for r in shred.id_lines(ids).collect()] == [(1, True), (3, False)]
    with pytest.raises(PySparkException, match="line 3"):
        shred.strict_ids(ids).collect()


def test_shredding(spark):
    bodies = ['{"items": [{"id": "a", "contentDetails": {"duration": "PT5S"}}, {"snippet": {}}]}', "not json", "{}", '{"items": [{"id": "b", "status": {"madeForKids": "maybe"}}]}']
    out = {r.id: (r.duration_s, r.live, r.made_for_kids, r.title) for r in shred.items(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()}
    assert out == {"a": (5, "none", False, ""), "b": (0, "none", False, "")}


def test_texts_must_be_texts(spark):
    bodies = ['{"items": [{"id": 5}, {"id": "c", "snippet": {"title": 7, "defaultLanguage": "en"}, "status": {"madeForKids": true}}]}', '{"items": {}}']
    out = [(r.id, r.title, r.made_for_kids, r.language) for r in shred.items(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()]
    assert out == [("c", "", True, "en")]
    tokens = spark.createDataFrame([('{"nextPageToken": "x"}',), ('{"nextPageToken": ""}',), ('{"nextPageToken": 3}',), ("{}",), ("junk",), (None,)], "body string")
    assert [r.t for r in tokens.select(scalars.next_token(F.col("body")).alias("t")).collect()] == ["x", None, None, None, None, None]


def test_running_sums(spark):
    rng = random.Random(8)
    rows = [(f"g{rng.randrange(3)}", i, rng.randrange(3), rng.random() < 0.1) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, i long, n int, stop boolean").repartition(5)
    upto, since, total = {}, {}, 0
    for g, i, n, stop in sorted(rows):
        total += n
        upto[i] = total
        since[i] = 0 if stop else since.get(g, 0) + n
        since[g] = since[i]
    assert {r.i: r.s for r in with_running_sum(df, "n", "g", "i", name="s").collect()} == upto
    assert {r.i: r.s for r in with_sum_since(df, F.col("n"), F.col("stop"), "g", "i", name="s").collect()} == {k: v for k, v in since.items() if isinstance(k, int)}
    assert with_sum_since(df.limit(0), F.col("n"), F.col("stop"), "g", "i", name="s").count() == 0


def test_searches_resume(spark):
    pages = spark.createDataFrame([("a", 1, "t1"), ("a", 2, "t2"), ("b", 3, "t3"), ("b", 4, None), ("c", 5, "x"), ("c", 6, "y"), ("c", 7, "z")], "query string, at long, next string")
    state = budget.search_resume(pages, 3)
    assert {r["query"]: (r.pages, r.next, r.done) for r in state.collect()} == {"a": (2, "t2", False), "b": (2, None, True), "c": (3, "z", True)}
    listed = spark.createDataFrame([("c", 0), ("new", 1), ("a", 2), ("b", 3)], "query string, query_pos long")
    calls = lambda quota, spent=0: [(r["query"], r.page, r.token) for r in budget.search_next(state, listed, quota, 3, spent=spent).orderBy("units").collect()]
    assert calls(1000) == [("new", 0, None), ("new", 1, None), ("new", 2, None), ("a", 2, "t2")]
    assert calls(300, 100) == calls(1000)[:2] and calls(99) == []
    ups = spark.createDataFrame([("x", 1, 50, "t"), ("x", 2, 50, "u"), ("y", 1, 200, None), ("z", 1, 10, "v")], "channel string, at long, n long, next string")
    assert {r.channel: (r.found, r.next, r.done, r.note) for r in budget.upload_resume(ups, 100).collect()} == {"x": (100, "u", True, "max_uploads_per_channel"), "y": (200, None, True, None), "z": (10, "v", False, None)}


def test_exhausted_quota_ends_the_day(spark):
    rows = [("d", 1, 10, ""), ("d", 2, 10, "quotaExceeded"), ("d", 3, 10, ""), ("e", 4, 10, "forbidden"), ("e", 5, 100, "")]
    out = budget.quota_guard(spark.createDataFrame(rows, "day string, id long, cost long, reason string"), 100, "reason")
    assert {tuple(r) for r in out.collect()} == {("d", 2, 20, 3), ("e", 1, 10, 5)}


def test_leases_of_addresses(spark):
    s = 1_000_000
    df = log(spark, [(1 * s, "w", "p/a", "x", "bot_check"), (2 * s, "w", "p/b", "x", "fetched"), (2 * s, "w", "p/c", "x", "bot_check"), (3 * s, "w", "p/c", "x", "bot_check")])
    ips = health.ip_health(df, Fetch(bot_check_limit=2))
    listed = spark.createDataFrame([("one", "p/a"), ("one", "p/b"), ("one", "p/new"), ("two", "p/c"), ("three", "p/a"), ("three", "p/a"), ("four", "p/b")], "pool string, label string")
    leases = spark.createDataFrame([("p/new", 100 * s), ("p/b", 3 * s)], "label string, lease_until_us long")
    got = lambda at, cap=0: {r.pool: (r.outcome, r.label, r.lease_until_us, r.wait_s) for r in health.ip_lease(listed, ips, leases, df, at, cap, 60).collect()}
    assert got(10 * s) == {"one": ("take", "p/b", 70 * s, None), "two": ("all_retired", None, None, None), "three": ("wait", None, None, 5.0), "four": ("take", "p/b", 70 * s, None)}
    assert got(10 * s, 1)["four"] == ("wait", None, None, 5.0) and got(300 * s)["three"] == ("wait", None, None, 1.0) and got(300 * s)["one"][1] == "p/new"


def test_stopped_workers_hand_back_at_once(spark):
    s = queue.SECOND_US
    events = spark.createDataFrame([("a", 0, 1, "lease", "w", 1800, None, 0), ("a", 5 * s, 2, "requeue", "w", 0, None, 0)], EVENTS)
    state = queue.queue_state(events)
    row = state.first()
    assert (row.attempts, row.lease_owner, row.lease_until_us) == (1, None, 5 * s)
    vids = admission.check(spark.createDataFrame([video("a", 9, "seed"), video("b", 1, "expand:UC1"), video("c", 4)], VIDEO)).selectExpr("*", "CAST(NULL AS string) AS batch")
    nxt = queue.lease_next(queue.leasable(vids, state, 6 * s), 3, 3, 6 * s, 30).collect()
    assert [(r.id, r.worker, r.attempts) for r in nxt] == [("b", 2, 1), ("c", 0, 1), ("a", 1, 2)]  # leased c, a, b; given back by seq


def test_channels_are_found_by_handle_or_id(spark):
    responses = spark.createDataFrame([("@a", "UC1", 1, "UU1"), ("@a", "UC9", 2, "UU9"), (None, "UC2", 3, None), ("@n", None, 4, "UU4")], "handle string, id string, pos long, uploads string")
    wanted = spark.createDataFrame([("@a",), ("UC1",), ("UC2",), ("@n",), ("UC7",)], "channel string")
    out = {r.channel: (r.resolved, r.uploads, r.note) for r in frontier.find_channels(wanted, responses).collect()}
    gone = (None, None, "not found")
    assert out == {"@a": ("UC1", "UU1", None), "UC1": ("UC1", "UU1", None), "UC2": gone, "@n": gone, "UC7": gone}


def test_whole_queue_log_is_folded(spark, sf_dir):
    from millrace.plans import catalogue
    from millrace.sources import fixtures

    log = fixtures.queue_events(spark, sf_dir)
    state = catalogue.QUERIES["queue_state_all"](spark, sf_dir)
    assert log.filter(F.col("at_us") > catalogue.AS_OF_US).count() > 0 and catalogue.QUERIES["leasable"](spark, sf_dir).count() > 0
    assert state.agg(F.sum("attempts")).first()[0] == log.filter("kind = 'lease'").count()
    assert catalogue.QUERIES["lease_intervals_all"](spark, sf_dir).count() == log.filter("kind = 'lease'").count()
    assert state.filter("fetch_state IS NOT NULL").count() == log.filter("kind = 'finish'").select("video").distinct().count()


def test_priority_without_limit_keeps_all(spark):
    rows = [video(f"v{i:03}", i, "expand:UC1" if i % 2 else "seed") for i in range(301)]
    out = frontier.by_priority(spark.createDataFrame(rows, VIDEO)).orderBy("place").collect()
    assert [(r.place, r.id) for r in out] == list(enumerate([f"v{i:03}" for i in [*range(0, 301, 2), *range(1, 301, 2)]]))


def test_searches_of_all_documents(spark, sf_dir):
    from millrace.plans import catalogue

    ids = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()]
    counts = {r.what: r.n for r in catalogue.QUERIES["frontier_counts_all"](spark, sf_dir).collect()}
    assert counts["searches done"] + counts["searches pending"] == len(ids)
    assert {r.query for r in catalogue.QUERIES["pending_searches_all"](spark, sf_dir).collect()} == {f"q{i}" for i in ids if i % 2}
