"""Quality classifier: a byte-level convolutional network in numpy.

The document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters of ``width``
bytes run over every position (a filter is one weight per offset and byte value, so a position's response is a sum
of table rows); each chunk keeps every filter's largest response, rectified; the mean over the chunks goes through
a logistic layer. Training uses a bounded sample of labelled rows and every chunk of each; scoring reads every byte.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_fields, bounded_batches, stash

_BLOCK = 128  # half-chunks convolved at once


@dataclass(frozen=True)
class Params:
    filters: int = 16
    width: int = 5
    #: A chunk spans two half-chunks; neighbouring chunks share one.
    half: int = 256
    #: The bound of the training sample: labelled rows (those with the smallest hash of their id).
    max_rows: int = 2000
    epochs: int = 10
    batch: int = 64
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    #: (width, 256, filters), (filters,), (filters,), scalar
    table: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float
    params: Params


def responses(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(positions, filters): every filter's sum at every position of ``data``; bytes past the end weigh nothing."""
    width = len(table)
    got = table[0].take(data, axis=0)
    for j in range(1, min(width, len(data))):
        got[: len(data) - j] += table[j].take(data[j:], axis=0)
    return got


def features(text: bytes, table: np.ndarray, bias: np.ndarray, p: Params) -> np.ndarray:
    """The mean over all chunks of the rectified largest responses; zeros for an empty text."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(len(bias), np.float64)
    halves = []
    step = p.half * _BLOCK
    for at in range(0, len(data), step):
        got = responses(data[at : at + step + p.width - 1], table)[: min(step, len(data) - at)]
        halves.append(np.maximum.reduceat(got, np.arange(0, len(got), p.half), axis=0))
    tops = np.concatenate(halves)
    if len(tops) > 1:
        tops = np.maximum(tops[:-1], tops[1:])
    return np.maximum(tops + bias, 0).mean(axis=0, dtype=np.float64)


def probability(text: bytes, m: Model) -> float:
    z = float(features(text, m.table, m.bias, m.params) @ m.out) + m.shift
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def text_chunks(text: bytes, table: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, filters) twice: each filter's largest response in every chunk of the text, and where it first occurs."""
    data = np.frombuffer(text, np.uint8)
    step, filters = p.half * _BLOCK, table.shape[2]
    tops, places = [np.zeros((0, filters), np.float32)], [np.zeros((0, filters), np.int64)]
    for at in range(0, len(data), step):
        got = responses(data[at : at + step + p.width - 1], table)[: min(step, len(data) - at)]
        whole = len(got) // p.half
        for first, part in ((0, got[: whole * p.half].reshape(whole, p.half, filters)), (whole, got[None, whole * p.half :])):
            if part.size:
                turned = np.ascontiguousarray(part.transpose(0, 2, 1))
                best = turned.argmax(axis=2)
                tops.append(np.take_along_axis(turned, best[:, :, None], axis=2)[:, :, 0])
                places.append(best + (at + p.half * (first + np.arange(len(part))))[:, None])
    top, place = np.concatenate(tops), np.concatenate(places)
    if len(top) > 1:
        earlier = top[:-1] >= top[1:]
        top, place = np.where(earlier, top[:-1], top[1:]), np.where(earlier, place[:-1], place[1:])
    return top, place


def train(texts: Sequence[Iterable[bytes]], labels: np.ndarray, p: Params) -> Model:
    """Adam on the logistic loss over all bytes of each text. One label only (or no rows) gives a constant model of that rate.

    Each item of ``texts`` gives the pieces of one text, and is asked for once an epoch; one text is held at a time.
    """
    rng = np.random.default_rng(p.seed)
    weights = {
        "table": rng.normal(0, 0.3, (p.width, 256, p.filters)).astype(np.float32), "bias": np.zeros(p.filters, np.float32),
        "out": rng.normal(0, 0.3, p.filters).astype(np.float32), "shift": np.zeros(1, np.float32),
    }
    rate = float(labels.mean()) if len(labels) else 0.5
    if rate in (0.0, 1.0) or not len(labels):
        return Model(weights["table"], weights["bias"], np.zeros(p.filters), float(np.log(min(max(rate, 0.01), 0.99) / (1 - min(max(rate, 0.01), 0.99)))), p)
    cells = 256 * p.filters
    m1, m2 = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    t = 0
    for _ in range(p.epochs):
        for rows in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // p.batch)):
            grad = {k: p.decay * v for k, v in weights.items()}
            for r in rows:
                text = b"".join(texts[r])
                data = np.frombuffer(text, np.uint8)
                tops, places = text_chunks(text, weights["table"], p)
                tops = tops + weights["bias"]
                live = tops > 0
                share = 1.0 / max(1, len(tops))
                pooled = np.where(live, tops, 0).sum(axis=0, dtype=np.float64) * share
                z = float(pooled @ weights["out"]) + float(weights["shift"][0])
                error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels[r]) / len(rows)
                back = error * weights["out"] * share
                grad["out"] = grad["out"] + error * pooled
                grad["shift"] = grad["shift"] + error
                grad["bias"] = grad["bias"] + back * live.sum(axis=0)
                at, of = places[live], np.nonzero(live)[1]
                for j in range(p.width):
                    inside = at + j < len(data)
                    hits = np.bincount(data[at[inside] + j].astype(np.int64) * p.filters + of[inside], minlength=cells)
                    grad["table"][j] += (hits.reshape(256, p.filters) * back).astype(np.float32)
            t += 1
            for k, g in grad.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                weights[k] = (weights[k] - p.rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Model(weights["table"], weights["bias"], weights["out"].astype(np.float64), float(weights["shift"][0]), p)


class StoredTexts(Sequence):
    """Texts one after the other in a file, each read when it is asked for."""

    def __init__(self, file: BinaryIO, spans: list[tuple[int, int]]):
        self.file, self.spans = file, spans

    def __len__(self) -> int:
        return len(self.spans)

    def __getitem__(self, i: int) -> list[bytes]:
        start, size = self.spans[i]
        self.file.seek(start)
        return [self.file.read(size)]


def fit(
    docs: DataFrame, labels: DataFrame, use: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", params: Params = Params(),
) -> Model:
    """Learn from labelled documents for which ``use`` (over the id column) holds.

    The sample is bounded by ``max_rows`` alone: each of its texts is read whole, from a temporary file of the driver
    that holds the sample. Rows without a label or id are left out. A repeated label row counts once, a document with
    both labels once with each; of several texts with one id the one with the smallest hash is read, so the sample
    does not depend on the order of the rows.
    """
    picked = labels.filter(use & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
    picked = picked.distinct().orderBy(F.xxhash64("_id"), "_id", "_label").limit(params.max_rows)  # so many narrow rows at most
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).join(F.broadcast(picked), "_id")
    one = F.min_by("_text", F.struct(F.xxhash64("_text"), "_text")).cast("binary").alias("_text")
    sample = stash(joined.groupBy("_id", "_label").agg(one), "sample")
    with tempfile.TemporaryFile() as file:
        found = []
        for r in sample.toLocalIterator():
            found.append((r._id, r._label, file.tell(), len(r._text)))
            file.write(r._text)
        found.sort(key=lambda r: r[:2])
        return train(StoredTexts(file, [r[2:] for r in found]), np.array([r[1] for r in found], np.float32), params)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs plus score and predicted (columns of those names are replaced). One map over the rows, no shuffle.

    Without ``keep_text`` the text column goes, and does not travel back from the Python workers.

    score lies in 0..1, higher for likelier label 1; null and empty texts have the score of no evidence. Every
    row is scored over all its bytes; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    at = kept.index(text_col)
    told = [i for i, c in enumerate(kept) if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([probability((x.as_py() or "").encode(), shared.value) for x in batch.column(at)], np.float64)
            new = [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in told), *new], names=[*(kept[i] for i in told), "score", "predicted"])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    fields = arrow_fields(rows.select(*[F.col(f"`{kept[i]}`") for i in told]))
    return rows.mapInArrow(run, ", ".join([*([fields] if fields else []), "score double", "predicted int"]))
