"""Connected components over a table of links, as rounds of minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut

MAX_ROUNDS = 100
#: Links that one task takes; a small table stays in few partitions, as each costs files in every shuffle of every round.
TASK_LINKS = 100_000


def components(links: DataFrame) -> DataFrame:
    """links(a, b) of longs -> (id, component): the smallest id reachable, for every id that a link names.

    Each round, a node takes the smallest label among its own, its neighbours' and its label's label, and hands the
    smallest label it sees to the node its own label names; the rounds grow with the logarithm of the longest path.
    Links with a null end or equal ends join nothing; repeated links and empty tables are fine. A node with many
    links is no bottleneck: minima are taken per task before they are shuffled, and neighbour lists never built.
    An error after MAX_ROUNDS rounds, which no graph that fits a cluster needs.
    """
    both = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    edges = cut(both.union(both.select("b", "a")).distinct())
    tasks = -(-edges.count() // TASK_LINKS) or 1
    edges = edges.coalesce(tasks)
    labels = cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")).coalesce(tasks))
    for _ in range(MAX_ROUNDS):
        # One join and two aggregates a round: the driver plans each anew, and large plans are what fills its memory.
        steps = edges.union(labels.filter("label < id"))
        near = steps.join(labels.select(F.col("id").alias("b"), "label"), "b").coalesce(tasks)
        near = near.select(F.col("a").alias("id"), F.col("label").alias("near"), F.lit(None).cast("long").alias("own"))
        seen = near.union(labels.select("id", "label", "label")).coalesce(tasks).groupBy("id").agg(F.min("near").alias("near"), F.max("own").alias("own"))
        none = F.lit(None).cast("long")
        offers = F.array(F.struct("id", F.col("near").alias("offer"), "own"), F.when(F.col("near") < F.col("own"), F.struct(F.col("own").alias("id"), F.col("near").alias("offer"), none.alias("own"))))
        offers = seen.select(F.explode(offers).alias("to")).filter("to IS NOT NULL").select("to.*").coalesce(tasks)
        new = offers.groupBy("id").agg(F.min("offer").alias("label"), F.max("own").alias("own"))
        new = cut(new.select("id", "label", (F.col("label") < F.col("own")).alias("moved")).coalesce(tasks))
        labels = new.select("id", "label")
        if not new.filter("moved").head(1):
            return labels.select("id", F.col("label").alias("component"))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
