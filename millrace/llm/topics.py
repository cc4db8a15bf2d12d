"""Topics of documents: k-means over hashed words of all documents.

A text's vector holds a damped count of each hashed word times the word's rarity, at length 1. The mean of the vectors of
its language is taken off, so that topics tell apart what is written about, not the language. Rarity, means and centres
are sums over every text; a bounded sample only says where the centres start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_fields, bounded_batches, stash
from millrace.llm.shingles import placed_words, word_hashes

EMPTY = "empty"
#: Components count in steps of 1 / SCALE. Vectors have a length of 1 and centres, means taken off, of 2 at most, so that
#: products stay near 2**21, and sums of BLOCK rows below 2**19: whole numbers that float32 holds exactly, in any order.
SCALE, BLOCK = 1024, 256
#: Texts in a row of the table of vectors, where a bucket is a place of one byte in one of the text's pages.
PACKED, PAGE = 16, 256
#: Texts are hashed together up to so many bytes and so many of them.
JOINED, JOINED_TEXTS = 1 << 15, 64


@dataclass(frozen=True)
class Params:
    topics: int = 8
    buckets: int = 1024
    #: The bound of the sample that the first centres come from: texts, those with the smallest hash of id, language and text.
    max_rows: int = 2000
    #: So many languages, those with most texts, have a mean of their own; all other texts take off the mean of all.
    languages: int = 256
    rounds: int = 50
    seed: int = 3


@dataclass(frozen=True)
class Model:
    rarity: np.ndarray
    #: The mean vector of each language, and of all texts for others (None).
    means: dict[str | None, np.ndarray]
    centers: np.ndarray
    params: Params


@dataclass(frozen=True)
class Counts:
    """What ``count`` found: rows of (key, said, the kept columns as c0 and so on, at, n), where said is the language."""

    rows: DataFrame
    kept: tuple[str, ...]
    params: Params


def word_counts(text: bytes, p: Params) -> np.ndarray:
    return np.bincount((word_hashes(text) >> np.uint64(32)).astype(np.int64) % p.buckets, minlength=p.buckets)


def _steps(places: np.ndarray, n: np.ndarray, each: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The components of texts at length 1, in whole steps: buckets and counts of all texts in a row, ``each`` of them a text's."""
    x, starts = np.log1p(n) * rarity[places], np.cumsum(each) - each
    lengths = np.sqrt(np.add.reduceat(x * x, starts)) if len(each) else np.zeros(0)  # each text has words
    return np.rint(x / np.repeat(lengths, each) * SCALE).astype(np.int16)


class _Nearest:
    """The nearest centre of texts, of equally near ones the first. All numbers are whole, so that the product with a centre
    less that of the mean is the product of the difference: no vector has its mean taken off."""

    def __init__(self, means: np.ndarray, centers: np.ndarray):
        self.across = np.ascontiguousarray(centers.T, np.float32)
        self.less = means @ centers.T + (centers * centers).sum(axis=1) / 2
        self.room = np.zeros((BLOCK, len(self.across)), np.float32)

    def blocks(self, places: np.ndarray, x: np.ndarray, sizes: np.ndarray, langs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(centres, languages, vectors) of up to BLOCK texts; the next block overwrites the vectors. sizes: of each text the
        number of buckets in each page; with one page places are whole."""
        pages = (np.arange(BLOCK)[:, None] * self.room.shape[1] + np.arange(sizes.shape[1]) * PAGE).reshape(-1)
        ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=1, dtype=np.int64))])
        for start in range(0, len(sizes), BLOCK):
            of, count = langs[start : start + BLOCK], sizes[start : start + BLOCK].reshape(-1)
            part, dense = slice(ends[start], ends[start + len(of)]), self.room[: len(of)]
            dense.fill(0)
            spots = np.repeat(pages[: len(count)], count)
            spots += places[part]
            self.room.reshape(-1)[spots] = x[part]
            yield (dense @ self.across - self.less[of]).argmax(axis=1), of, dense


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, of equally near ones the first."""
    return (x @ centers.T - (centers * centers).sum(axis=1) / 2).argmax(axis=1)


def cluster(x: np.ndarray, p: Params) -> np.ndarray:
    """k-means with spread-out first centres; the centres come by falling size of their clusters."""
    rng = np.random.default_rng(p.seed)
    if not len(x):
        return np.zeros((1, p.buckets))
    picked = [int(rng.integers(len(x)))]
    far = ((x - x[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < p.topics and far.max() > 1e-12:
        picked.append(int(rng.choice(len(x), p=far / far.sum())))
        far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(axis=1))
    centers, at = x[picked].copy(), None
    for _ in range(p.rounds):
        new = nearest(x, centers)
        if at is not None and (new == at).all():
            break
        at = new
        for k in range(len(centers)):
            if (at == k).any():
                centers[k] = x[at == k].mean(axis=0)
    sizes = np.bincount(at, minlength=len(centers))
    return centers[np.argsort(-sizes, kind="stable")]


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of binaries, one after the other, and how many each row has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // np.dtype(kind).itemsize
    data = column.buffers()[2]
    return (np.frombuffer(data, kind)[ends[0] : ends[-1]] if data is not None else np.zeros(0, kind)), np.diff(ends)


def _binaries(values: np.ndarray, each: np.ndarray, kind: type) -> pa.Array:
    """The numbers as a column of binaries, ``each`` of them a row's."""
    ends = np.concatenate([[0], np.cumsum(each)]) * np.dtype(kind).itemsize
    return pa.Array.from_buffers(pa.binary(), len(each), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.astype(kind))])


def _counted_texts(texts: pa.Array, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets that the words of each text fall in, ascending, how many do, and how many buckets each text has."""
    found = [(np.zeros(0, np.int64),) * 3]
    values = [v or b"" for v in texts.cast(pa.large_binary()).to_pylist()]
    ends, start = np.cumsum([len(v) + 1 for v in values]), 0
    while start < len(values):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + JOINED_TEXTS, int(np.searchsorted(ends, before + JOINED, "right"))))
        group = values[start:stop]
        if len(group) == 1:
            counts = word_counts(group[0], p)
        else:
            at, words = placed_words(b" ".join(group))
            of = np.repeat(np.arange(len(group)), np.diff(np.searchsorted(at, ends[start:stop] - before), prepend=0))
            counts = np.bincount(of * p.buckets + (words >> np.uint64(32)).astype(np.int64) % p.buckets, minlength=len(group) * p.buckets)
        spots = np.flatnonzero(counts)
        of, places = np.divmod(spots, p.buckets)
        found.append((places, counts[spots], np.bincount(of, minlength=len(group))))
        start = stop
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def count(docs: DataFrame, keep: list[str], *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", params: Params = Params()) -> Counts:
    """Hash the words of every text once, for ``fit_counts`` and ``assign_counts``, which read no text. keep: the columns that
    ``assign_counts`` is to return. Null texts are empty."""
    p = params
    if not 0 < p.buckets <= 1 << 16:
        raise ValueError("buckets must be between 1 and 65536")
    bounded_batches(docs.sparkSession)
    of = {name: F.col(f"`{c}`") for name, c in (("id", id_col), ("lang", lang_col), ("text", text_col))}
    key = F.xxhash64(of["id"], of["lang"], of["text"]).alias("key")
    rows = docs.select(key, of["lang"].alias("said"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], of["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, n, each = _counted_texts(batch.column(batch.num_columns - 1), p)
            new = [_binaries(places, each, np.uint16), _binaries(n, each, np.int32)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [*batch.schema.names[:-1], "at", "n"])

    return Counts(stash(rows.mapInArrow(run, f"{arrow_fields(rows.drop('text'))}, at binary, n binary"), "topic-counts"), tuple(keep), p)


def _vectors(texts: DataFrame, rarity: np.ndarray, langs: dict[str, int]) -> DataFrame:
    """(langs, sizes, at, x, over, more) of up to PACKED texts a row, one after the other: languages, numbers of buckets in each
    page, buckets as places in their pages, and the lower bytes of the components in whole steps; over and more are the
    numbers in the row, and the upper bytes, of the few components above 255."""
    pages = -(-len(rarity) // PAGE)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (places, each), (n, _) = _flat(batch.column(1), np.uint16), _flat(batch.column(2), np.int32)
            of = np.array([langs.get(v, len(langs)) for v in batch.column(0).to_pylist()], np.int64)
            starts = np.arange(0, len(each), PACKED)
            texts, numbers = np.diff(np.append(starts, len(each))), np.add.reduceat(each, starts) if len(each) else each
            row = np.repeat(np.arange(len(starts)), numbers)
            sizes = np.bincount(np.repeat(np.arange(len(each)), each) * pages + places // PAGE, minlength=len(each) * pages)
            x = _steps(places, n, each, rarity)
            over = np.flatnonzero(x > 255)
            overs = np.bincount(row[over], minlength=len(starts))
            new = [_binaries(of, texts, np.int32), _binaries(sizes, texts * pages, np.uint16), _binaries(places % PAGE, numbers, np.uint8), _binaries(x & 255, numbers, np.uint8),
                   _binaries(over - (np.cumsum(numbers) - numbers)[row[over]], overs, np.int32), _binaries(x[over] >> 8, overs, np.uint8)]
            yield pa.RecordBatch.from_arrays(new, ["langs", "sizes", "at", "x", "over", "more"])

    schema = "langs binary, sizes binary, at binary, x binary, over binary, more binary"
    return stash(texts.select("said", "at", "n").mapInArrow(weigh, schema), "topic-vectors")


def _unpacked(batch: pa.RecordBatch, pages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Languages, numbers of buckets by text and page, places in pages and components of all texts of the batch."""
    (of, _), (sizes, _), (places, each), (low, _), (over, overs), (more, _) = (
        _flat(c, kind) for c, kind in zip(batch.columns, (np.int32, np.uint16, np.uint8, np.uint8, np.int32, np.uint8), strict=True)
    )
    x = low.astype(np.float32)
    x[over + np.repeat(np.cumsum(each) - each, overs)] += more.astype(np.float32) * 256
    return of, sizes.reshape(-1, pages), places, x


def _summed(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]], width: int) -> dict[int, np.ndarray]:
    """What ``run`` gives per task, (part, sums), added up by part on the executors."""
    schema = "part long, sums binary"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sums in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([sums.astype(np.int64).tobytes()], pa.binary())], ["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, name = np.zeros(width, np.int64), None
        for batch in batches:
            for part, sums in zip(batch.column(0), batch.column(1), strict=True):
                name, total = part.as_py(), total + np.frombuffer(sums.as_py(), np.int64)
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    add.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    found = rows.mapInArrow(each, schema).groupBy("part").applyInArrow(add, schema).toArrow()
    return {part.as_py(): np.frombuffer(sums.as_py(), np.int64) for part, sums in zip(found.column("part"), found.column("sums"), strict=True)}


def _texts_by_bucket(counted: DataFrame, p: Params) -> np.ndarray:
    """How many texts hold a word of each bucket, and last how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros(p.buckets + 1, np.int64)
        for batch in batches:
            total[:-1] += np.bincount(_flat(batch.column(0), np.uint16)[0], minlength=p.buckets)
            total[-1] += batch.num_rows
        yield 0, total

    return _summed(counted.select("at"), run, p.buckets + 1).get(0, np.zeros(p.buckets + 1, np.int64))


def _totals(vectors: DataFrame, langs: int, means: np.ndarray | None, centers: np.ndarray | None, p: Params) -> dict[int, np.ndarray]:
    """The sum of the vectors, and last their number, of each language (``means`` and ``centers`` None) or, less the means,
    of those nearest to each centre; the first of equally near ones. langs: how many languages, with that of all others."""

    pages = -(-p.buckets // PAGE)

    def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros((langs, p.buckets + 1), np.int64)
        for batch in batches:
            of, sizes, places, x = _unpacked(batch, pages)
            used, at = np.unique(of, return_inverse=True)
            spots = np.repeat(at[:, None] * p.buckets + np.arange(pages) * PAGE, sizes.reshape(-1)) + places
            total[used, :-1] += np.bincount(spots, x, len(used) * p.buckets).reshape(len(used), -1).astype(np.int64)
            total[used, -1] += np.bincount(at, minlength=len(used))
        for k in np.flatnonzero(total[:, -1]):
            yield int(k), total[k]

    def by_center(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        near, one = _Nearest(means, centers), np.eye(len(centers), dtype=np.float32)
        total, pairs = np.zeros((len(centers), p.buckets)), np.zeros(len(centers) * langs, np.int64)
        for batch in batches:
            of, sizes, places, x = _unpacked(batch, pages)
            for at, said, dense in near.blocks(places, x, sizes, of):
                total += one[at].T @ dense
                pairs += np.bincount(at * langs + said, minlength=len(pairs))
        pairs = pairs.reshape(-1, langs)
        for k in np.flatnonzero(pairs.sum(axis=1)):
            yield int(k), np.append(total[k] - pairs[k] @ means, pairs[k].sum())

    return _summed(vectors, by_language if centers is None else by_center, p.buckets + 1)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", params: Params = Params()) -> Model:
    """Learn from every text that holds words, see ``fit_counts``."""
    return fit_counts(count(docs, [], id_col=id_col, text_col=text_col, lang_col=lang_col, params=params))


def fit_counts(counts: Counts) -> Model:
    """Learn from every text that holds words; repeated rows count as often as they are there. The model follows from the
    rows alone, not their order: sums are of whole numbers.

    Texts' vectors are written once and read again each round; a task sends a row of ``8 * buckets`` bytes per centre (or
    language), added up before the driver gets them. Rounds end when no centre moves by a step of 1 / SCALE, or after
    ``rounds``. A table without words gives one topic. The driver gets ``max_rows`` vectors for the first centres.
    """
    p, counted = counts.params, counts.rows.filter("octet_length(at) > 0")
    bounded_batches(counted.sparkSession)
    texts = _texts_by_bucket(counted, p)
    rarity = np.log((1 + texts[-1]) / (1 + texts[:-1])) + 1
    if not texts[-1]:
        return Model(rarity, {None: np.zeros(p.buckets)}, np.zeros((1, p.buckets)), p)

    by_size = counted.filter("said IS NOT NULL").groupBy("said").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "said").limit(p.languages)
    langs = {r.said: i for i, r in enumerate(by_size.collect())}
    last = len(langs)  # stands for all other languages
    vectors = _vectors(counted, rarity, langs)
    sums = _totals(vectors, last + 1, None, None, p)
    means = np.zeros((last + 1, p.buckets))
    for i, total in [*sums.items(), (last, np.sum(list(sums.values()), axis=0))]:
        means[i] = np.rint(total[:-1] / total[-1])

    key = counted.select("key").orderBy("key").limit(p.max_rows).agg(F.max("key")).first()[0]
    first = counted.select("key", "said", "at", "n").filter(F.col("key") <= F.lit(key)).dropDuplicates(["key"]).toArrow().sort_by("key").combine_chunks()
    (places, each), (n, _) = (_flat(first.column(c).combine_chunks(), kind) for c, kind in (("at", np.uint16), ("n", np.int32)))
    x = -means[[langs.get(v, last) for v in first.column("said").to_pylist()]]
    x[np.repeat(np.arange(len(each)), each), places] += _steps(places, n, each, rarity)
    centers, sizes = np.rint(cluster(x / SCALE, p) * SCALE), None
    for _ in range(p.rounds):
        new, sizes = centers.copy(), np.zeros(len(centers), np.int64)
        for k, total in _totals(vectors, last + 1, means, centers, p).items():
            new[k], sizes[k] = np.rint(total[:-1] / total[-1]), total[-1]
        if (new == centers).all():
            break
        centers = new
    return Model(rarity, {None: means[last] / SCALE, **{v: means[i] / SCALE for v, i in langs.items()}}, centers[np.argsort(-sizes, kind="stable")] / SCALE, p)


def _labeller(model: Model) -> Callable[[np.ndarray, np.ndarray, np.ndarray, list], list[pa.Array]]:
    """What gives topics and numbers of words of texts: of their buckets and counts in a row, how many of them are each
    text's, and the languages. In the whole steps of the fit, so that no text's topic depends on those beside it."""
    said = {v: i for i, v in enumerate(model.means)}
    near = _Nearest(np.rint(np.stack([*model.means.values()]) * SCALE), np.rint(model.centers * SCALE))

    def label(places: np.ndarray, n: np.ndarray, each: np.ndarray, langs: list) -> list[pa.Array]:
        of, some = np.array([said.get(v, said[None]) for v in langs], np.int64), each > 0
        topics = np.full(len(each), -1)
        found = [at for at, *_ in near.blocks(places, _steps(places, n, each[some], model.rarity), each[some][:, None], of[some])]
        topics[some] = np.concatenate(found) if found else 0
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[np.concatenate([[0], np.cumsum(each)])]
        return [pa.array([EMPTY if k < 0 else f"t{k}" for k in topics.tolist()], pa.string()), pa.array(np.diff(ends), pa.int64())]

    return label


def assign(docs: DataFrame, model: Model, *, text_col: str = "text", lang_col: str = "lang", keep_text: bool = True) -> DataFrame:
    """docs plus topic ("t0" and so on; "empty" for a text without words) and n_tokens, its words (columns of those names
    are replaced). Null texts are empty; every text is read whole; one map over the rows, without a shuffle."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("topic", "n_tokens")]
    at, lang_at = kept.index(text_col), kept.index(lang_col)
    out = [i for i, c in enumerate(kept) if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = _labeller(shared.value)
        for batch in batches:
            new = label(*_counted_texts(batch.column(at), shared.value.params), batch.column(lang_at).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in out), *new], names=[*(kept[i] for i in out), "topic", "n_tokens"])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    fields = arrow_fields(rows.select(*[F.col(f"`{kept[i]}`") for i in out]))
    return rows.mapInArrow(run, f"{fields}, topic string, n_tokens long")


def assign_counts(counts: Counts, model: Model) -> DataFrame:
    """As ``assign``, for the kept columns and without the texts."""
    bounded_batches(counts.rows.sparkSession)
    shared = counts.rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = _labeller(shared.value)
        for batch in batches:
            said, at, n = batch.columns[-3:]
            (places, each), (n, _) = _flat(at, np.uint16), _flat(n, np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *label(places, n, each, said.to_pylist())], [*batch.schema.names[:-3], "topic", "n_tokens"])

    kept = [F.col(f"c{i}") for i in range(len(counts.kept))]
    fields = "".join(f"{f}, " for f in [arrow_fields(counts.rows.select(*kept))] if f)
    rows = counts.rows.select(*kept, "said", "at", "n").mapInArrow(run, f"{fields}topic string, n_tokens long")
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(counts.kept)], "topic", "n_tokens")
