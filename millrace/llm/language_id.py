"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting: every task counts hashed n-grams of its labelled texts per language with numpy and hands on one row per
(language, bucket) it met; Spark sums them and packs each language's log probabilities into one row. The model is a
matrix of log probabilities of fixed height (buckets) and one column per language; it is broadcast in blocks of at
most ``Params.block`` languages. Scoring: the (row, bucket) pairs of a batch of texts are counted by sorting them,
and these sparse counts are multiplied by the matrix.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_fields, bounded_batches, stash

#: Code points that are turned into n-grams at once; longer texts go in pieces of this size.
_CHUNK = 1 << 17
_BLANK = 32
_FOLD: list[np.ndarray] = []


@dataclass(frozen=True)
class Params:
    orders: tuple[int, ...] = (1, 2, 3)
    buckets: int = 1 << 15
    smoothing: float = 0.5
    #: The score is the posterior per ``scale`` n-grams, as single n-grams of a text are far from independent; the
    #: predicted language is that of the posterior itself, which is the same.
    scale: float = 50.0
    #: Languages in one broadcast matrix: with 2**15 buckets in single precision at most 32 MB.
    block: int = 256


@dataclass(frozen=True)
class Block:
    """Languages in alphabetical order, log priors, and log probabilities (buckets, languages)."""

    langs: list[str]
    prior: np.ndarray
    matrix: np.ndarray


@dataclass(frozen=True)
class Model:
    blocks: list[Block]
    params: Params

    @property
    def langs(self) -> list[str]:
        return [x for b in self.blocks for x in b.langs]


def _fold() -> np.ndarray:
    """Code point -> lower-case letter, or a blank for what is no letter."""
    if not _FOLD:
        table = np.full(0x110000, _BLANK, np.uint32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 and low.isalpha() else c
        _FOLD.append(table)
    return _FOLD[0]


def _letters(text: str) -> np.ndarray:
    return _fold()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


def _squeezed(points: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where a point is not a blank after a blank of the same row."""
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != _BLANK) | (points[:-1] != _BLANK) | (row[1:] != row[:-1])
    return keep


def _hashed(points: np.ndarray, row: np.ndarray, counted: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each n-gram within one row that ends after the first ``counted`` points."""
    rows, buckets = [], []
    points, shift = points.astype(np.uint64), np.uint64(64 - (p.buckets.bit_length() - 1))
    for n in p.orders:
        m = max(0, len(points) - n + 1)
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h = (h ^ points[i : m + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        first = max(0, counted - n + 1)
        inside = np.flatnonzero(row[first:m] == row[first + n - 1 : m + n - 1]) + first
        rows.append(row[inside])
        buckets.append((h[inside] * np.uint64(0xBF58476D1CE4E5B9) >> shift).astype(np.int64))
    return np.concatenate(rows), np.concatenate(buckets)


def ngrams(texts: Iterable[str], p: Params) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all n-grams of all texts, in blocks of bounded size.

    A text is read as a blank and its letters in lower case; runs of other characters count as one blank.
    """
    short: list[tuple[int, str]] = []
    size, over = 0, max(p.orders) - 1

    def flush() -> tuple[np.ndarray, np.ndarray]:
        points = _letters("".join(" " + t for _, t in short))
        row = np.repeat([i for i, _ in short], [len(t) + 1 for _, t in short])
        keep = _squeezed(points, row)
        return _hashed(points[keep], row[keep], 0, p)

    for i, text in enumerate(texts):
        if len(text) < _CHUNK:
            short.append((i, text))
            size += len(text) + 1
            if size >= _CHUNK:
                yield flush()
                short, size = [], 0
            continue
        tail, counted = np.array([_BLANK], np.uint32), 0
        for at in range(0, len(text), _CHUNK):
            points = np.concatenate([tail, _letters(text[at : at + _CHUNK])])
            points = points[_squeezed(points, np.zeros(len(points), np.int8))]
            yield _hashed(points, np.full(len(points), i), counted, p)
            tail = points[-over:] if over else points[-1:]
            counted = len(tail)
    if short:
        yield flush()


def fit(docs: DataFrame, use: Column, *, text_col: str = "text", lang_col: str = "lang", params: Params = Params()) -> Model:
    """Learn from the rows where ``use`` holds and neither text nor language is null.

    Any number of languages can be learnt; the driver gets one row of ``4 * buckets`` bytes (128 KB) for each, and a
    task holds counts of at most ``Params.block`` languages at a time. Null texts and languages are left out, empty
    texts count for the prior; an empty table gives a model without languages.
    """
    p = params
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        total, n_docs = np.zeros((0, p.buckets), np.int64), np.zeros(0, np.int64)

        def counted() -> Iterator[pa.RecordBatch]:
            for name, k in names.items():
                at = np.flatnonzero(total[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1)), pa.array(np.append(total[k][at], n_docs[k]))],
                    ["lang", "bucket", "n"],
                )

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start in range(0, len(langs), p.block):  # a slice names at most so many languages
                part = langs[start : start + p.block]
                if names and len(names.keys() | set(part)) > p.block:
                    yield from counted()
                    names, total, n_docs = {}, total[:0], n_docs[:0]
                codes = np.array([names.setdefault(x, len(names)) for x in part], np.int64)
                if len(names) > len(total):
                    total = np.concatenate([total, np.zeros((len(names) - len(total), p.buckets), np.int64)])
                    n_docs = np.concatenate([n_docs, np.zeros(len(names) - len(n_docs), np.int64)])
                n_docs += np.bincount(codes, minlength=len(names))
                flat = total.reshape(-1)
                for row, bucket in ngrams((x.as_py() for x in batch.column(1).slice(start, p.block)), p):
                    cell = codes[row] * p.buckets + bucket
                    if len(flat) <= 1 << 20:
                        flat += np.bincount(cell, minlength=len(flat))
                    else:
                        at, n = np.unique(cell, return_counts=True)
                        flat[at] += n
        yield from counted()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n_docs, name = np.zeros(p.buckets), 0, None
        for batch in batches:
            bucket, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            head = bucket < 0
            counts[bucket[~head]] += n[~head]
            n_docs += int(n[head].sum())
            name = batch.column(0)[0].as_py() if batch.num_rows else name
        counts += p.smoothing
        logs = np.log(counts / counts.sum()).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([n_docs], pa.int64()), pa.array([logs.tobytes()], pa.binary())], ["lang", "docs", "logs"])

    pack.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    rows = docs.filter(use & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.groupBy("lang").applyInArrow(pack, "lang string, docs long, logs binary").toArrow().sort_by("lang")
    langs, n_docs = found.column("lang").to_pylist(), found.column("docs").to_numpy().astype(np.float64)
    prior, blocks = np.log(n_docs / max(n_docs.sum(), 1)), []
    for k in range(0, len(langs), p.block):
        logs = [np.frombuffer(x.as_py(), np.float32) for x in found.column("logs")[k : k + p.block]]
        blocks.append(Block(langs[k : k + p.block], prior[k : k + p.block], np.ascontiguousarray(np.stack(logs, axis=1))))
    return Model(blocks, p)


def sparse_scores(texts: list[str], matrix: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(log likelihoods (texts, languages), n-grams per text) from the sparse counts of a batch of texts."""
    logs, sizes = np.zeros((len(texts), matrix.shape[1])), np.zeros(len(texts), np.int64)
    for row, bucket in ngrams(texts, p):
        pair, count = np.unique(row * p.buckets + bucket, return_counts=True)
        if not len(pair):
            continue
        row, bucket = pair // p.buckets, pair % p.buckets
        start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        here = row[start]
        sizes[here] += np.add.reduceat(count, start)
        step = max(1, (1 << 22) // max(1, len(pair)))  # languages at once, so that the product stays small
        for k in range(0, matrix.shape[1], step):
            logs[here, k : k + step] += np.add.reduceat(matrix[bucket, k : k + step] * count[:, None].astype(np.float64), start, axis=0)
    return logs, sizes


def best_of(texts: list[str], block: Block, p: Params) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
    """For each text the likeliest language of the block (None in an empty one), the log of its joint probability with
    the text, the mass of the block's languages relative to it, and the number of ``scale`` n-grams in the text."""
    logs, sizes = sparse_scores(texts, block.matrix, p)
    temper = np.maximum(sizes / p.scale, 1.0)
    if not block.langs:
        return [None] * len(texts), np.full(len(texts), -np.inf), np.ones(len(texts)), temper
    logs += block.prior
    best = logs.argmax(axis=1)
    top = logs[np.arange(len(texts)), best]
    return [block.langs[i] for i in best], top, np.exp((logs - top[:, None]) / temper[:, None]).sum(axis=1), temper


def joined(one: tuple, two: tuple) -> tuple:
    """``best_of`` over two blocks from that over each, the alphabetically first block first."""
    (names, top, mass, temper), (names2, top2, mass2, _) = one, two
    high = np.maximum(top, top2)
    mass = mass * np.exp((top - high) / temper) + mass2 * np.exp((top2 - high) / temper)
    return [b if newer else a for a, b, newer in zip(names, names2, top2 > top, strict=True)], high, mass, temper


def told(texts: list[str], found: tuple) -> tuple[list[str], np.ndarray]:
    """(lang_pred, score) from ``best_of`` over all languages."""
    names, _, mass, _ = found
    known = np.array([n is not None and any(map(str.isalpha, t)) for n, t in zip(names, texts, strict=True)], bool)
    return [n if ok else "und" for n, ok in zip(names, known, strict=True)], np.where(known, 1.0 / mass, 0.0)


def score_text(text: str | None, model: Model) -> tuple[str, float]:
    """(language, score) of one text, as ``predict`` gives them."""
    texts = [text or ""]
    found = best_of(texts, Block([], np.zeros(0), np.zeros((model.params.buckets, 0), np.float32)), model.params)
    for k, block in enumerate(model.blocks):
        more = best_of(texts, block, model.params)
        found = joined(found, more) if k else more
    names, scores = told(texts, found)
    return names[0], float(scores[0])


def text_counts(text: str, p: Params) -> np.ndarray:
    """The counts of one text's n-grams per bucket."""
    return sum((np.bincount(bucket, minlength=p.buckets) for _, bucket in ngrams([text], p)), np.zeros(p.buckets, np.int64))


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs plus lang_pred and score (columns of those names are replaced). One map over the rows for each block of
    languages, no shuffle. Without ``keep_text`` the text column goes, and does not travel back from the workers.

    lang_pred is the language of the largest posterior, of equal ones the first in alphabetical order; score is its
    share of the posterior per ``scale`` n-grams. A null text, one without a letter, and any text under a model
    without languages gives "und" and 0. Every row is scored over its whole text, repeated rows alike; an empty table
    gives no rows. A model of several blocks is applied block after block, with a table written between two blocks.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at, p = kept.index(text_col), model.params
    state = ["_lang_best", "_lang_log", "_lang_mass"]  # the best so far, its posterior's log, the mass relative to it
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    blocks = model.blocks or [Block([], np.zeros(0), np.zeros((p.buckets, 0), np.float32))]
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        out_at = [i for i, c in enumerate(kept) if keep_text or not last or c != text_col]
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0, last=last, out_at=out_at) -> Iterator[pa.RecordBatch]:
            b = shared.value
            for batch in batches:
                texts = [x or "" for x in batch.column(at).to_pylist()]
                found = best_of(texts, b, p)
                if not first:
                    was = batch.column(len(kept)).to_pylist(), *(batch.column(len(kept) + i).to_numpy() for i in (1, 2))
                    found = joined((*was, found[3]), found)
                if last:
                    names, scores = told(texts, found)
                    new = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                else:
                    new = [pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()), pa.array(found[2], pa.float64())]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in out_at), *new], names=[*(kept[i] for i in out_at), *(("lang_pred", "score") if last else state)])

        out = "lang_pred string, score double" if last else "_lang_best string, _lang_log double, _lang_mass double"
        fields = arrow_fields(rows.select(*[F.col(f"`{kept[i]}`") for i in out_at]))
        rows = rows.mapInArrow(run, ", ".join([*([fields] if fields else []), out]))
        if not last:
            rows = stash(rows, "lang-block")
    return rows
