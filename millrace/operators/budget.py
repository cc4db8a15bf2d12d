"""Budgets: paged searches and uploads, the quota ledger, and what becomes of each API response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.carried import Fold, carried
from millrace.functions.positions import with_running_sum
from millrace.functions.scalars import pacific_day

RETRIES = 5
EXHAUSTED = ("quotaExceeded", "dailyLimitExceeded")


def search_budget(pages: DataFrame, quota: int, pages_per_query: int, cost: int = 100, spent: int = 0) -> DataFrame:
    """The pages (query, query_pos, page) that may be fetched: the first few of each query, in query order, until
    the next call would overdraw the search quota. All calls cost the same, so a query's start follows from the
    page counts of the queries before it; that running sum goes over range partitions with a row per query."""
    few = pages.filter(F.col("page") < pages_per_query)
    rank = F.row_number().over(Window.partitionBy("query_pos", "query").orderBy("page")) - 1
    sizes = few.groupBy("query_pos", "query").agg(F.count(F.lit(1)).alias("n"))
    before = with_running_sum(sizes, "n", "query_pos", "query", name="_upto").withColumn("before", F.col("_upto") - F.col("n")).drop("n", "_upto")
    placed = few.withColumn("rank", rank).join(before, ["query_pos", "query"])
    units = spent + (F.col("before") + F.col("rank") + 1) * cost
    return placed.withColumn("units", units.cast("long")).filter(F.col("units") <= quota).drop("rank", "before")


def upload_cap(pages: DataFrame, cap: int) -> DataFrame:
    """pages(channel, page, n): fetched while fewer than ``cap`` uploads were found before, so a page may overshoot.

    A channel may have any share of all pages."""
    return carried(pages, ("channel",), ("page",), found_before=Fold("sum", F.col("n"), before=True)).filter(F.col("found_before") < cap)


def search_resume(pages: DataFrame, pages_per_query: int) -> DataFrame:
    """pages(query, at, next), a row per page fetched in the order of ``at``, next the token of the page after it ->
    (query, pages, next, done): where each search goes on. Done without a next page or after ``pages_per_query``."""
    last = F.max_by(F.struct("next"), F.col("at")).alias("last")
    out = pages.groupBy("query").agg(F.count(F.lit(1)).alias("pages"), last)
    return out.select("query", "pages", F.col("last.next").alias("next"), (F.col("last.next").isNull() | (F.col("pages") >= pages_per_query)).alias("done"))


def search_next(state: DataFrame, listed: DataFrame, quota: int, pages_per_query: int, cost: int = 100, spent: int = 0) -> DataFrame:
    """The calls of the next run: for each of listed(query, query_pos) that is not done the pages that it still may take,
    in list order, until the quota is spent; the first call of a search starts at its token.

    A search without a state starts at its first page."""
    have = listed.join(state, "query", "left").filter(~F.coalesce("done", F.lit(False)))
    first = F.coalesce("pages", F.lit(0)).cast("long")
    have = have.filter(first < pages_per_query).withColumn("page", F.explode(F.sequence(first, F.lit(pages_per_query - 1).cast("long"))))
    have = have.withColumn("token", F.when(F.col("page") == first, F.col("next"))).select("query", "query_pos", "page", "token")
    return search_budget(have, quota, pages_per_query, cost, spent)


def upload_resume(pages: DataFrame, cap: int) -> DataFrame:
    """pages(channel, at, n, next) -> (channel, found, next, done, note): a channel is done without a next page, or once
    it has given ``cap`` uploads, which is noted."""
    last = F.max_by(F.struct("next"), F.col("at")).alias("last")
    out = pages.groupBy("channel").agg(F.sum("n").cast("long").alias("found"), last)
    ended, full = F.col("last.next").isNull(), F.col("found") >= cap
    return out.select("channel", "found", F.col("last.next").alias("next"), (ended | full).alias("done"), F.when(~ended & full, "max_uploads_per_channel").alias("note"))


def quota_by_day(ledger: DataFrame) -> DataFrame:
    """ledger(day, cost, search) -> units used per day, and those of searches."""
    return ledger.groupBy("day").agg(F.sum("cost").cast("long").alias("used"), F.sum(F.when(F.col("search"), F.col("cost")).otherwise(0)).cast("long").alias("search_used"), F.count(F.lit(1)).alias("calls"))


def quota_by_run_day(calls: DataFrame, runs: DataFrame) -> DataFrame:
    """calls(id, at, cost, search) and runs(at), both UTC -> (day, used, search_used, calls, late).

    A run charges all its calls to the day on which it began, in the time zone of the quota, also those after midnight; late
    counts these. A call belongs to the last run that began at or before it; one before any run counts on its own day. Calls
    and starts are merged in one order, in which the last start is carried on; there is no join on a range.
    """
    starts = runs.select("at").distinct().select("at", F.lit(-1).cast("long").alias("id"), F.lit(None).cast("long").alias("cost"), F.lit(None).cast("boolean").alias("search"), F.lit(False).alias("call"))
    merged = starts.unionByName(calls.select("at", F.col("id").cast("long").alias("id"), F.col("cost").cast("long").alias("cost"), "search", F.lit(True).alias("call")))
    rows = carried(merged, (), ("at", "call", "id"), run=Fold("last", F.when(~F.col("call"), F.col("at")))).filter("call")
    own, day = pacific_day(F.col("at")), pacific_day(F.coalesce("run", "at"))
    rows = rows.select(day.alias("day"), "cost", "search", (own != day).alias("late"))
    searched = F.sum(F.when(F.col("search"), F.col("cost")).otherwise(0)).cast("long")
    return rows.groupBy("day").agg(F.sum("cost").cast("long").alias("used"), searched.alias("search_used"), F.count(F.lit(1)).alias("calls"), F.count_if("late").alias("late"))


def quota_guard(ledger: DataFrame, quota: int, reason: str | None = None) -> DataFrame:
    """Per day the calls that the quota lets through, in the order of their id; the first refusal ends the day's run.

    reason: a column with the reason of the response; one that says the quota is exhausted was paid for, and leaves
    nothing for the calls after it. A day may hold any share of all calls.
    """
    told = F.lit(0) if reason is None else F.when(F.col(reason).isin(*EXHAUSTED), 1).otherwise(0)
    rows = carried(ledger.select("day", "id", "cost", told.alias("told")), ("day",), ("id",), running=Fold("sum", F.col("cost")), told_before=Fold("sum", F.col("told"), before=True))
    ok = (F.col("running") <= quota) & (F.col("told_before") == 0)
    return rows.groupBy("day").agg(F.count_if(ok).alias("allowed"), F.coalesce(F.max(F.when(ok, F.col("running"))), F.lit(0)).cast("long").alias("used"), F.min(F.when(~ok, F.col("id"))).alias("refused_at"))


def api_outcomes(responses: DataFrame) -> DataFrame:
    """responses(status, body, attempt) plus reason and outcome: ok, empty, out_of_quota, retry or error.

    status null stands for a transport error. Up to five retries are made of those, of 5xx and of rate limits. A body that
    is no JSON makes a 200 an error.
    """
    reason = F.coalesce(F.get_json_object("body", "$.error.errors[0].reason"), F.lit(""))
    transient = F.col("status").isNull() | (F.col("status") >= 500) | F.col("reason").isin("rateLimitExceeded", "userRateLimitExceeded")
    outcome = (
        F.when((F.col("status") == 200) & F.try_parse_json("body").isNull(), "error").when(F.col("status") == 200, "ok").when(F.col("status") == 404, "empty")
        .when(F.col("status").isNotNull() & F.col("reason").isin(*EXHAUSTED), "out_of_quota")
        .when(transient & (F.col("attempt") < RETRIES), "retry").otherwise("error")
    )
    wait = F.when(F.col("outcome") == "retry", F.pow(F.lit(2), F.col("attempt") + 1))
    return responses.withColumn("reason", reason).withColumn("outcome", outcome).withColumn("wait_factor", wait.cast("long"))
