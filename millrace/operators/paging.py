"""The order of pages from their tokens alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import fresh_dir

#: Rounds double the stretch that a page has walked back, so this is more than any list needs.
MAX_ROUNDS = 60


def _written(df: DataFrame) -> DataFrame:
    path = fresh_dir(df.sparkSession, "paging")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def page_chain(pages: DataFrame) -> DataFrame:
    """pages(query, id, token, next) -> (query, id, token, next, page, head, state): ``token`` is the one that a page was asked
    for with (null: a first page), ``next`` the one that it gave (null: a last page); ``id`` tells rows apart.

    page: its number from 0 in the chain of pages that lead to it, head the id of the chain's first page. state: "whole" if that is
    a first page; "broken" if no page gives the head's token, so what came before is missing; "repeated" for a page asked for
    with a token that a page of smaller id was asked for with (it has that page's number and leads nowhere); "circular" if
    its tokens lead back to it (page and head are null). Of several pages that give one token the smallest id leads on.

    Pages are ranked by pointer doubling: each round a page takes over its leader's leader, so a chain of n pages takes log2(n)
    joins on an equal key, and no chain is gathered in one task. Each round is written below the shared folder.
    """
    first = F.min("id").alias("id")
    once = pages.groupBy("query", "token").agg(first)  # one page a token counts; first pages share the token null
    asked = pages.join(once.select(F.col("query").alias("_q"), F.col("token").alias("_t"), F.col("id").alias("lead")), F.col("query").eqNullSafe(F.col("_q")) & F.col("token").eqNullSafe(F.col("_t"))).drop("_q", "_t")
    asked = _written(asked)
    own = asked.filter("id = lead")
    gives = own.filter("next IS NOT NULL").groupBy(F.col("query").alias("_q"), F.col("next").alias("_t")).agg(F.min("id").alias("before"))
    links = own.join(gives, F.col("query").eqNullSafe(F.col("_q")) & (F.col("token") == F.col("_t")), "left")
    state = links.select("id", F.col("before").alias("to"), F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("far"), F.col("token").isNull().alias("start"))
    state = _written(state.withColumn("to", F.coalesce("to", "id")).withColumn("ended", F.col("far") == 0))
    n = state.filter("NOT ended").count()
    for _ in range(min(MAX_ROUNDS, n.bit_length() + 1)):
        lead = state.select(F.col("id").alias("to"), F.col("to").alias("on"), F.col("far").alias("more"), F.col("ended").alias("there"), F.col("start").alias("from_start"))
        moved = state.filter("NOT ended").join(lead, "to").select("id", F.col("on").alias("to"), (F.col("far") + F.col("more")).alias("far"), F.col("from_start").alias("start"), F.col("there").alias("ended"))
        state = _written(state.filter("ended").unionByName(moved))
        left = state.filter("NOT ended").count()
        if not left:
            break
    ranks = state.select(F.col("id").alias("lead"), F.when(F.col("ended"), F.col("far")).alias("page"), F.when(F.col("ended"), F.col("to")).alias("head"), F.col("start"))
    out = asked.join(ranks, "lead")
    said = F.when(F.col("id") != F.col("lead"), "repeated").when(F.col("head").isNull(), "circular").when(F.col("start"), "whole").otherwise("broken")
    return out.select("query", "id", "token", "next", "page", "head", said.alias("state"))
