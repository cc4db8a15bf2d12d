"""Exact dedup by sorting content, with built-in functions only.

Normalised texts are range-partitioned by sampled splitters and sorted externally, so equal texts stand next to
each other; neighbours are compared in full (the window's key is the whole text, not a hash of it). A text so
frequent that it would fill a partition is dealt over several slots beside each other; the winners of its slots,
a bounded number of rows, are merged afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import NO_ID, WHITE, shuffle_partitions, stash, text_of

#: A text counts as frequent above 1/HOT_SHARE of a mean partition's rows, but never below LEAST_HOT rows.
HOT_SHARE = 4
LEAST_HOT = 200
#: Code points of a text that a splitter may hold.
HEAD = 32


def normalised(text: Column) -> Column:
    """The text without the six white-space characters."""
    for ch in WHITE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def frequent_texts(texts: DataFrame, partitions: int) -> DataFrame:
    """(key, slots) of the texts that need more than one slot: at most ``HOT_SHARE * partitions`` rows.

    A row stands for more than total / (HOT_SHARE * partitions) rows of the input, which bounds their number. A
    clash of two keys only gives both texts several slots; it does not mix them.
    """
    total = texts.count()
    least = max(LEAST_HOT, -(-total // (HOT_SHARE * partitions)))
    counts = texts.groupBy(F.xxhash64("norm").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > least).select("key", F.ceil(F.col("n") / F.lit(least)).alias("slots"))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting white space (space, tab to carriage return). Of equal texts the
    row with the most code points in the original stays, then the smallest id; a null id comes last among ties
    and is returned as null. Null text counts as empty; empty texts form one group. Rows repeated with the same
    id are separate rows, of which one is kept. An empty table gives no rows; other columns are ignored.

    Two shuffles: a narrow count of text hashes (partial sums first), and the range exchange of the texts. The
    table of frequent texts is broadcast; its size is bounded by the number of partitions (see frequent_texts).
    """
    n = partitions or shuffle_partitions(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (-F.length(text)).alias("rank"), normalised(text).alias("norm"))
    hot = frequent_texts(rows.select("norm"), n)
    slot = F.when(F.col("slots").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("slots")))
    rows = rows.withColumn("key", F.xxhash64("norm")).join(F.broadcast(hot), "key", "left")
    rows = rows.select("doc_id", "rank", "norm", slot.cast("int").alias("slot"), F.col("slots").isNotNull().alias("hot"))

    # The splitters are sampled from bounded keys (the head of the text, then its hash), as samples go to the driver.
    rows = rows.withColumn("head", F.substring("norm", 1, HEAD)).withColumn("key", F.xxhash64("norm"))
    placed = rows.repartitionByRange(n, "head", "key", "slot")
    best_first = Window.partitionBy("head", "key", "slot", "norm").orderBy("rank", F.col("doc_id").asc_nulls_last())
    whole = best_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = placed.select(
        "doc_id", "hot", F.first("doc_id").over(whole).alias("near_id"), F.first("rank").over(whole).alias("near_rank"),
        F.count(F.lit(1)).over(whole).alias("near_size"), (F.row_number().over(best_first) == 1).alias("first"), F.sha2("norm", 256).alias("text_sha256"),
    )
    compared = stash(compared, "content-sort")

    best = F.min(F.struct("near_rank", F.col("near_id").isNull().alias("no_id"), "near_id"))
    merged = compared.filter("hot AND first").groupBy("text_sha256").agg(best.alias("best"), F.sum("near_size").alias("whole_size"))
    out = compared.join(F.broadcast(merged), "text_sha256", "left")
    keep = F.when(F.col("best").isNull(), F.col("near_id")).otherwise(F.col("best.near_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("whole_size", "near_size").cast("long").alias("group_size"),
        (F.col("first") & F.coalesce("doc_id", F.lit(NO_ID)).eqNullSafe(F.coalesce(keep, F.lit(NO_ID)))).alias("kept"), "text_sha256",
    )
