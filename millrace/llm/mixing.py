"""Mixing sources to target weights by iterative proportional fitting, then sampling by calibrated probabilities.

Token counts are summed per cell (source, language, topic). The cell weights are raked: scaled to the target of
each margin in turn, sweep after sweep, until all margins meet their targets. A document's probability is its cell's
weight per token of the cell, scaled so that the wanted share of all tokens is drawn, but 1 at most; a document is drawn
when a number fixed by its id lies below its probability. Topics come from clusters of the words (``topics``) unless the caller names them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import topics
from millrace.llm.common import cut, stash, text_of

MARGINS = ("source", "lang", "topic")
NONE = "(none)"
#: So many cells may be raked on the driver (about 10 MB).
LOCAL_CELLS = 100_000
#: What a margin may be off by, as a share of its target, and how many sweeps are made at most.
TOLERANCE, SWEEPS = 1e-9, 1000


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def power_targets(cells: DataFrame, exponents: dict[str, float]) -> dict[str, DataFrame]:
    """Per margin: (value, target), each value's share of the tokens to a power, normalised to sum to 1.

    A power below 1 raises small sources; 1 keeps a margin as it is.
    """
    out = {}
    for margin, power in exponents.items():
        sums = cells.groupBy(F.col(margin).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(float(power))).alias("w"))
        whole = sums.agg(F.sum("w").alias("whole"))
        out[margin] = sums.join(F.broadcast(whole)).select("value", (F.col("w") / F.col("whole")).alias("target"))  # one row
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int, local_cells: int = LOCAL_CELLS, tolerance: float = TOLERANCE) -> DataFrame:
    """cells(source, lang, topic, tokens) plus weight and margin_error.

    The sweeps end when no margin of the weights differs from its target by more than ``tolerance`` of that target, or
    after ``sweeps`` of them, where the targets contradict each other or the cells. margin_error, the same in all
    rows, is the largest such difference that is left. A value without a target keeps its weight; a target without
    tokens cannot be met and does not count. The table has a row per cell, never per document. Up to ``local_cells``
    cells (counted first) the sweeps run in numpy on the driver; beyond that they run as Spark aggregates, cut after
    each margin. Both give the same weights.
    """
    for margin, target in targets.items():
        cells = cells.join(target.select(F.col("value").alias(margin), F.col("target").alias(f"_to_{margin}")), margin, "left")
    cells = cut(cells)
    if cells.count() <= local_cells:
        return _rake_local(cells, list(targets), sweeps, tolerance)
    now, error = cells.withColumn("weight", F.col("tokens").cast("double")), 0.0
    for _ in range(sweeps):
        for margin in targets:
            have = now.groupBy(margin).agg(F.sum("weight").alias("_have"))
            factor = F.coalesce(F.col(f"_to_{margin}") / F.nullif(F.col("_have"), F.lit(0.0)), F.lit(1.0))
            now = cut(now.join(have, margin).withColumn("weight", F.col("weight") * factor).drop("_have"))
        error = 0.0
        for margin in targets:
            to = F.col(f"_to_{margin}")
            have = now.groupBy(margin, to).agg(F.sum("weight").alias("have"))
            error = max(error, have.agg(F.max(F.abs(F.col("have") / F.nullif(to, F.lit(0.0)) - 1))).first()[0] or 0.0)
        if error <= tolerance:
            break
    return now.select(*MARGINS, "tokens", "weight", F.lit(float(error)).alias("margin_error"))


def _rake_local(cells: DataFrame, margins: list[str], sweeps: int, tolerance: float) -> DataFrame:
    rows = cells.orderBy(*MARGINS).toPandas()
    weight = rows["tokens"].to_numpy(np.float64).copy()
    codes = {m: np.unique(rows[m].to_numpy(str), return_inverse=True)[1] for m in margins}
    to = {m: rows[f"_to_{m}"].to_numpy(np.float64) for m in margins}
    have = lambda m: np.bincount(codes[m], weight)[codes[m]]
    error = 0.0
    for _ in range(sweeps if len(weight) else 0):
        with np.errstate(divide="ignore", invalid="ignore"):
            for m in margins:
                factor = to[m] / have(m)
                weight *= np.where(np.isfinite(factor), factor, 1.0)
            off = np.concatenate([np.abs(have(m) / to[m] - 1) for m in margins])
        error = float(off[np.isfinite(off)].max(initial=0.0))
        if error <= tolerance:
            break
    rows["weight"], rows["margin_error"] = weight, error
    out = "source string, lang string, topic string, tokens long, weight double, margin_error double"
    return cells.sparkSession.createDataFrame(rows[[*MARGINS, "tokens", "weight", "margin_error"]], out)


#: Factors tried in one pass over the cells, and passes; each narrows the factor to one of them.
_TRIED, _PASSES = 64, 6


def _factor(raked: DataFrame, share: float) -> float:
    """The factor c by which sum(least(tokens, c * weight)) over the cells is the share of all tokens.

    Cells fill up like vessels of unequal width: those of the greatest weight per token first. Each pass is one aggregate over
    the cells."""
    known = raked.agg(F.sum("tokens").alias("tokens"), F.min(F.when(F.col("weight") > 0, F.col("weight") / F.col("tokens"))).alias("least")).first()
    if not known.tokens or not known.least:
        return 0.0
    low, high, wanted = 0.0, 1 / known.least, share * known.tokens
    for _ in range(_PASSES):
        tried = [low + (high - low) * k / _TRIED for k in range(1, _TRIED + 1)]
        each = raked.select("tokens", "weight", F.posexplode(F.array(*map(F.lit, tried))).alias("k", "c"))
        sums = each.groupBy("k").agg(F.sum(F.least(F.col("tokens").cast("double"), F.col("c") * F.col("weight"))).alias("drawn"))
        drawn = [r.drawn for r in sums.orderBy("k").collect()]
        at = next((k for k in range(_TRIED) if drawn[k] >= wanted), _TRIED - 1)
        low, high = (tried[at - 1] if at else low), tried[at]
    return high


def calibrate(raked: DataFrame, targets: dict[str, DataFrame], share: float | None) -> DataFrame:
    """raked cells plus rate (weight per token), prob and drawn_error, the largest difference of a margin of the tokens to be
    drawn from its target, as a share of the target; a target without tokens does not count.

    share: of all tokens that is wanted, 0 to 1. Probabilities are proportional to rates as far as they are below 1; a rare
    cell of high rate is drawn whole and the others make up for it. None: the largest probability is 1, so margins are
    as exact as the raking, but one rare cell says how much is drawn.
    """
    rates = raked.withColumn("rate", F.col("weight") / F.col("tokens"))
    if share is None:
        top = rates.agg(F.max("rate").alias("top"))  # one row
        rates = rates.join(F.broadcast(top)).withColumn("prob", F.col("rate") / F.col("top")).drop("top")
    else:
        rates = rates.withColumn("prob", F.least(F.lit(1.0), F.lit(_factor(raked, share)) * F.col("rate")))
    rates = cut(rates)
    whole, error = rates.agg(F.sum(F.col("prob") * F.col("tokens")).alias("n")).first().n or 0.0, 0.0
    for margin, target in targets.items():
        have = rates.groupBy(F.col(margin).alias("value")).agg(F.sum(F.col("prob") * F.col("tokens")).alias("n")).join(target, "value")
        off = F.abs(F.col("n") / F.lit(whole or 1.0) / F.nullif(F.col("target"), F.lit(0.0)) - 1)
        error = max(error, have.agg(F.max(off).alias("off")).first().off or 0.0)
    return rates.withColumn("drawn_error", F.lit(float(error)))


def mix(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic: Column | None = None,
    targets: dict[str, DataFrame] | None = None, exponents: dict[str, float] | None = None, sweeps: int = SWEEPS, seed: str = "mix", keep_text: bool = True, share: float | None = None,
) -> DataFrame:
    """docs plus topic, n_tokens, weight, prob, draw, drawn, margin_error and drawn_error (columns of those names are
    replaced); without ``keep_text`` the text column goes.

    targets: per margin (source, lang, topic) a table (value, target) with shares that sum to 1; without them the
    token shares to the ``exponents`` (default 0.7, 0.7 and 1). topic: a column; without it the clusters that
    ``topics`` learns from all documents. n_tokens: words. weight: the document's share of its
    cell's raked weight. draw: a number in 0..1 fixed by seed and id; repeated ids draw alike. margin_error: see
    ``rake``; above ``TOLERANCE`` the targets were not met. share: how much of all tokens is to be drawn, see ``calibrate``, which
    also tells about drawn_error. Null source, language or text count as the value
    "(none)" or the empty text; a document without tokens counts as one token, so that it can be drawn. An empty
    table gives no rows. No row is capped: each keeps its own probability.

    The cells are joined back to the documents by their key: broadcast up to LOCAL_CELLS of them (about 10 MB; they
    are counted), otherwise by a shuffle in which Spark splits the partitions of large cells.
    """
    new = ("topic", "n_tokens", "weight", "prob", "draw", "drawn", "margin_error", "drawn_error")
    kept = [c for c in docs.columns if c not in new]
    plain = docs.select(*[F.col(f"`{c}`") for c in kept])
    if topic is not None:
        told = plain.select("*", F.coalesce(topic, F.lit(NONE)).alias("topic"), words(text_of(text_col)).alias("n_tokens"))
        rows, narrow = (told if keep_text else told.drop(text_col)), told
    else:
        needed = list(dict.fromkeys((source_col, lang_col))) if keep_text else [c for c in kept if c != text_col]
        counts = topics.count(plain, needed, id_col=id_col, text_col=text_col, lang_col=lang_col)
        model = topics.fit_counts(counts)
        narrow = topics.assign_counts(counts, model)
        if keep_text:
            rows = topics.assign(plain, model, text_col=text_col, lang_col=lang_col)
        else:
            rows = narrow = stash(narrow, "topic-labels")
    key = {"source": F.coalesce(F.col(source_col), F.lit(NONE)), "lang": F.coalesce(F.col(lang_col), F.lit(NONE)), "topic": F.col("topic")}
    tokens = F.greatest(F.col("n_tokens"), F.lit(1))
    cells = stash(narrow.groupBy(*[c.alias(m) for m, c in key.items()]).agg(F.sum(tokens).alias("tokens")), "cells")
    targets = targets or power_targets(cells, exponents or {"source": 0.7, "lang": 0.7, "topic": 1.0})
    rates = calibrate(rake(cells, targets, sweeps), targets, share)
    rates = rates.select(*[F.col(m).alias(f"_mix_{m}") for m in MARGINS], F.col("rate").alias("_mix_rate"), "prob", "margin_error", "drawn_error")
    if cells.count() <= LOCAL_CELLS:
        rates = F.broadcast(rates)
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    out = rows.select("*", u.alias("draw")).join(rates, [key[m] == F.col(f"_mix_{m}") for m in MARGINS], "left")
    stay = [F.col(f"`{c}`") for c in kept if keep_text or c != text_col]
    return out.select(
        *stay, "topic", "n_tokens", (F.col("_mix_rate") * tokens).alias("weight"), "prob", "draw", (F.col("draw") < F.col("prob")).alias("drawn"), "margin_error", "drawn_error",
    )
