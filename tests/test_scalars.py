from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import scalars


def fold_duration(s: str):
    """The duration rules, one character after the other."""
    if not s.startswith("P"):
        return None
    digits, total, clock = "", 0, False
    for ch in s[1:]:
        if ch in "0123456789":
            digits += ch
        elif ch == "T":
            clock = True
        elif digits and ch in ("HMS" if clock else "WD"):
            total += int(digits) * scalars.UNIT_SECONDS[ch]
            digits = ""
        else:
            return None
    return None if digits else total


def test_durations(spark):
    units = {"PT7S": 7, "PT11M": 660, "PT9H4S": 32_404, "P3W": 1_814_400, "P2DT2M": 172_920, "P6D": 518_400, "P8T1M": 4_860, "PT2H2H": 14_400, "P0WT0S": 0}
    none = ["7S", "PT7", "P7M", "P7S", "PT7D", "P-1D", "PT 7S", " PT7S", "pt7s", "PT7,5S", "P1MT1S"]
    known = units | dict.fromkeys(none)
    rows = spark.createDataFrame([(k,) for k in known], "s string").select("s", scalars.parse_duration(F.col("s")).alias("v")).collect()
    assert {r.s: r.v for r in rows} == known == {k: fold_duration(k) for k in known}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("PTWDHMS0123456789x", max_size=10).map(lambda s: "P" + s), min_size=150, max_size=150))
def test_durations_match_the_fold(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", scalars.parse_duration(F.col("s")).alias("v")).collect()
    assert [(r.s, r.v) for r in rows] == [(r.s, fold_duration(r.s)) for r in rows]


def test_ids(spark):
    known = {
        "abcdefghijk": "abcdefghijk", "https://x/watch?v=abcdefghijk&t=1": "abcdefghijk", "https://youtu.be/abcdefghijk?si=2": "abcdefghijk",
        "abcdefghijk\n": None, "short": None, "abcdefghij!": None,
    }
    rows = spark.createDataFrame([(k,) for k in known], "s string").select("s", scalars.video_id(F.col("s")).alias("v")).collect()
    assert {r.s: r.v for r in rows} == known


def test_failures(spark):
    of = {"proxy_error": scalars.PROXY_TEXTS, "bot_check": scalars.BOT_TEXTS, "unavailable": scalars.GONE_TEXTS}
    known = {f"step 3 of 9\n{t.title()} ({c})": (c, f"{t.title()} ({c})") for c, texts in of.items() for t in texts}
    known |= {f"{scalars.GONE_TEXTS[2]} {scalars.BOT_TEXTS[3]}": ("bot_check", None), f"{scalars.BOT_TEXTS[4]}; {scalars.PROXY_TEXTS[4]}": ("proxy_error", None)}
    known |= {"  \n\t": ("failed", "no output"), "ERROR: disk is full\nbye": ("failed", "ERROR: disk is full"), "ERROR: a\nERROR: b\n": ("failed", "ERROR: b"), "error: lower case\nlast": ("failed", "last"), "q" * 301: ("failed", "q" * 300)}
    rows = spark.createDataFrame([(k,) for k in known], "s string").select("s", scalars.failure_class(F.col("s")).alias("c"), scalars.failure_reason(F.col("s")).alias("r")).collect()
    assert {r.s: (r.c, r.r) for r in rows} == {k: (c, k if r is None else r) for k, (c, r) in known.items()}


def test_redaction(spark):
    rows = [
        ("tried https://seat-9:v3lvet@exit.lattice.test:715 twice (v3lvet)", "https://seat-9:v3lvet@exit.lattice.test:715", "lattice/9"), ("nothing to hide", "http://192.0.2.44:8118", "y"),
        ("no password: seat-9", "https://seat-9@exit.lattice.test:715", "z"), ("empty: https://seat-9:@e.test:1", "https://seat-9:@e.test:1", "e"),
    ]
    got = spark.createDataFrame(rows, "t string, u string, l string").select(scalars.redact(F.col("t"), F.col("u"), F.col("l")).alias("t")).collect()
    assert [r.t for r in got] == ["tried lattice/9 twice (***)", "nothing to hide", "no password: seat-9", "empty: e"]


def test_numbers_in_json(spark):
    known = {'{"a": {"n": 12}}': 12, '{"a": {"n": "34"}}': 34, '{"a": {"n": "x"}}': None, '{"a": {}}': None, '{"a": ': None, "7": None, '{"a": {"n": -5}}': -5}
    rows = spark.createDataFrame([(k,) for k in known], "s string").select("s", scalars.json_long(F.col("s"), "$.a.n").alias("v")).collect()
    assert {r.s: r.v for r in rows} == known


def test_names(spark):
    got = spark.createDataFrame([(7,), (123456,)], "k long").select(scalars.shard_name(F.col("k")).alias("n")).collect()
    assert [r.n for r in got] == ["shard-00007.jsonl", "shard-123456.jsonl"]
