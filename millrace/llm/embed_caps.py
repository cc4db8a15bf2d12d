"""Embedding near-dedup by spherical-cap filters over a random product code.

A filter is a direction put together from one random unit vector per block of coordinates (after a random rotation), so
a few short lists of vectors span millions of filters; many such codes, each with its own lists, keep the filters from
failing a vector together. A vector is decoded to the list of all filters whose cap it lies in. Vectors in one cap meet
in one bucket. The caps are so many that a pair at the threshold is expected to share ``Params.shared`` of them; their
height weighs the rows that are sent against those that meet in a bucket.

Two steps: first every vector goes to each of its caps with a sketch of 512 signs alone, packed by the partition that
compares the cap. Vectors of a bucket that are joined by near sketches get the smallest of their ids as a label, so that
any two near ones share a label. Only rows with a label get their vector; they meet once more by labels, of which a
group of near copies has few, and cosines are taken in double precision.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import NO_ID, bounded_batches, cut, freed_shuffles, shuffle_partitions, stash
from millrace.llm.components import components

#: Rows of a bucket that one comparison block holds; larger buckets are compared block by block.
BLOCK = 1024
#: Vectors whose caps a task decodes and packs at once.
DECODED = 8192
#: Signs of a sketch; rows of a cap have much in common by chance, so that fewer would let too many pairs through.
SIGNS = 512
#: Signs that are compared first, the others only where these differ in few.
FIRST_SIGNS = 192
#: Rows of a bucket whose sketches are all compared at once; larger buckets are searched from one row to the next.
ALL_PAIRS = 512
#: A cap that holds more vectors by the sample is dealt out in parts of so many, each two of which meet.
SPLIT = 16_384
#: Bytes of the rows of caps that one task compares, and that one round sends for each byte of the vectors at most.
TASK_BYTES, ROUND_SHARE = 24 << 20, 2.5
#: A round of fewer bytes is not worth its jobs.
LEAST_ROUND = 256 << 20
#: A vector in a cap: the cap (and the part of a cap that is dealt out), the vector's id and its sketch.
ENTRY = np.dtype([("key", "<i8"), ("rep", "<i8"), ("signs", "<u8", (SIGNS // 64,))])
#: Caps of one vector length have numbers below; a large cap has so many parts at most.
CAPS, MOST_PARTS = 1 << 44, 512
#: Rows of caps that are packed at once, where large caps take a vector many times.
MOST_ENTRIES = 1 << 21


@dataclass(frozen=True)
class Params:
    threshold: float = 0.9
    #: Caps that a pair at the threshold is expected to share; caps of one code are not independent, see ``missed``.
    shared: float = 9.0
    #: A row that is sent to a cap costs as much as meeting so many others there, or as so many products of the decoder;
    #: this sets the height.
    in_cap: float = 150.0
    products: float = 8_000.0
    #: The sketches of a pair at the threshold differ in more signs than are let through with a chance of 3e-7.
    sigmas: float = 5.0
    #: The bound of the sample from which the loads of caps are taken, as vectors are not spread evenly.
    sample: int = 2000
    #: Pairs at the threshold on which a plan is tried, and the share of them that may have no cap in common.
    tried: int = 2000
    missed: float = 0.001
    codes: int = 64
    seed: int = 11


@dataclass(frozen=True)
class Code:
    height: float
    words: int
    blocks: int
    params: Params


def _tails(d: int, heights: np.ndarray) -> np.ndarray:
    """The share of a sphere's surface in d dimensions above each height."""
    angle = np.linspace(0, np.pi, 20_001)
    density = np.sin(angle) ** (max(d, 2) - 2)
    below = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
    return np.interp(np.arccos(np.clip(heights, -1, 1)), angle, below / below[-1])


def _again(d: int, height: float, cosine: float) -> float:
    """The chance that a vector lies in a cap, given that one at ``cosine`` to it does."""
    t = np.linspace(height, 1, 400)
    fall = np.log(np.maximum(1 - t * t, 1e-12))
    w = np.exp((max(d, 3) - 3) / 2 * (fall - fall[0]))
    rest = np.sqrt(max(1 - cosine**2, 1e-9)) * np.sqrt(np.maximum(1 - t * t, 1e-12))
    inner = _tails(d - 1, np.clip((height - cosine * t) / rest, -1, 1))
    return float((w * inner).sum() / w.sum())


def loads(x: np.ndarray, n: int, heights: np.ndarray, seed: int) -> np.ndarray:
    """For each height the vectors that one of n expects in its caps, from a sample of unit vectors: the mean over random
    directions, weighted by how many vectors they hold."""
    size = min(512, 4 * len(x))
    directions = np.random.default_rng([seed, x.shape[1]]).normal(size=(size, x.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    inside = np.sort(x @ directions.T, axis=0)
    share = np.stack([1 - np.array([np.searchsorted(c, h) for c in inside.T]) / len(x) for h in heights])
    return n * (share**2).sum(axis=1) / np.maximum(share.sum(axis=1), 1e-12)


def plan(n: int, d: int, p: Params, sample: np.ndarray | None = None) -> Code:
    """Cap height and code words per block for n vectors of d dimensions: the height of the least cost for a vector."""
    # two vectors at the threshold share no cap above the cosine of half their angle
    heights = np.linspace(0.1, 0.98 * np.sqrt((1 + p.threshold) / 2), 44)
    tails = _tails(d, heights)
    again = np.array([_again(d, h, p.threshold) for h in heights])
    load = n * tails if sample is None or not len(sample) else np.maximum(loads(sample, n, heights, p.seed), n * tails)
    per_code = p.shared / np.maximum(tails * again, 1e-12) / p.codes
    blocks = np.where((per_code <= 1 << 24) | (d < 16), 2, 4)
    words = np.maximum(2, np.ceil(per_code ** (1 / blocks)))
    rows = np.maximum(p.shared / np.maximum(again, 1e-12), p.codes * words**blocks * tails)
    products = p.codes * (blocks * words * d + np.where(blocks == 4, 60 * words**2, 0))
    k = int(np.argmin(rows * (1 + load / p.in_cap) + products / p.products))
    code = Code(float(heights[k]), int(words[k]), int(blocks[k]), p)
    # sums of unit vectors are no even spread of directions, least so in few dimensions: words are added until it is good enough
    rng = np.random.default_rng([p.seed, d])
    one, two = rng.normal(size=(2, p.tried, d))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    if d == 1:
        return code
    two -= (one * two).sum(axis=1, keepdims=True) * one
    two = p.threshold * one + np.sqrt(1 - p.threshold**2) * two / np.linalg.norm(two, axis=1, keepdims=True)
    while True:
        caps = Caps(n, {d: code}, p)
        common = np.array([np.intersect1d(a, b, assume_unique=True).size for a, b in zip(caps.of(one), caps.of(two), strict=True)])
        if (common == 0).sum() <= p.missed * p.tried and common.mean() >= 0.8 * p.shared:
            return code
        code = replace(code, words=code.words + max(1, code.words // 16))


@functools.lru_cache(maxsize=128)
def _rotation(seed: int, number: int, size: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng([seed, number, size]).normal(size=(size, size)))[0]


def codebook(d: int, code: Code, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """One code: a rotation of the (padded) coordinates, and per block its unit vectors. Of many dimensions, where a
    rotation takes room, codes share eight."""
    m = code.blocks
    size = -(-d // m) * m
    rng = np.random.default_rng([code.params.seed, number, d])
    part = size // m
    # words at right angles to each other, as many as there can be at a time, are spread more evenly than random ones
    turns = np.linalg.qr(rng.normal(size=(m, -(-code.words // part), part, part)))[0]
    turns *= rng.choice([-1.0, 1.0], size=(*turns.shape[:3], 1))
    return _rotation(code.params.seed, number if size <= 128 else number % 8, size), list(turns.reshape(m, -1, part)[:, : code.words])


@functools.lru_cache(maxsize=16)
def _directions(d: int, code: Code, numbers: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The words of the codes with these numbers in the vectors' own coordinates, by code, block and word: one a row, and
    in single precision one a column."""
    out = []
    for number in numbers:
        rotation, words = codebook(d, code, number)
        out += [w @ part.T for w, part in zip(words, np.split(rotation[:d], code.blocks, axis=1), strict=True)]
    rows = np.concatenate(out)
    return rows, np.ascontiguousarray(rows.T, np.float32)


def decode(unit: np.ndarray, code: Code, numbers: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(row, cap) for each unit vector, by row, and each filter of the codes at whose direction its product reaches the height.

    The sums of a left and a right half code are not tried one by one: only right ones beside a left one that can reach
    the height. Products in single precision decide but for those so near the height that their error matters; these are
    taken again in double precision, each by itself, so that the caps of a vector do not depend on its batch.
    """
    (n, d), m, b, k = unit.shape, code.blocks, code.words, len(numbers)
    rows, columns = _directions(d, code, numbers)
    scores = (unit.astype(np.float32) @ columns).reshape(n, k, m, b)

    def sums(parts: np.ndarray) -> np.ndarray:
        out = parts[:, :, 0]
        for i in range(1, m // 2):
            out = (out[..., :, None] + parts[:, :, i, None, :]).reshape(n, k, -1)
        return out

    left, right = sums(scores[:, :, : m // 2]), sums(scores[:, :, m // 2 :])
    half, need, error = b ** (m // 2), np.sqrt(m) * code.height, m * (d + 8) * 2.0**-23
    first = np.flatnonzero(left >= (need - error - right.max(axis=2))[:, :, None])
    value = left.reshape(-1)[first]
    found = []
    for lo in range(0, len(first), max(1, (1 << 20) // half)):
        at = first[lo : lo + max(1, (1 << 20) // half)]
        total = right.reshape(n * k, half)[at // half]
        total += value[lo : lo + len(at), None]
        hit = np.flatnonzero(total >= need - error)
        found.append((at[hit // half], hit % half, total.reshape(-1)[hit]))
    one, two, total = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    row, number = np.divmod(one // half, k)
    one %= half
    keep = total >= need + error
    near = np.flatnonzero(~keep)
    if len(near):
        direction = np.zeros((len(near), d))
        for i in range(m):
            word = (one if i < m // 2 else two)[near] // b ** (m // 2 - 1 - i % (m // 2)) % b
            direction += rows[(number[near] * m + i) * b + word]
        keep[near] = (unit[row[near]] * direction).sum(axis=1) / np.sqrt(m) >= code.height
    return row[keep], ((one * half + two) * code.params.codes + np.array(numbers)[number])[keep]


def _matrix(column: pa.Array, rows: np.ndarray | None = None) -> np.ndarray:
    """Vectors of one length, at length 1, as a matrix of doubles."""
    column = column if rows is None else column.take(pa.array(rows))
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that the squares of very small and large numbers do not vanish or overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@functools.lru_cache(maxsize=16)
def _planes(seed: int, d: int) -> np.ndarray:
    return np.random.default_rng([seed, 1 << 20, d]).normal(size=(d, SIGNS)).astype(np.float32)


class Caps:
    """The codes of each vector length, made when first needed, and the caps of vectors."""

    def __init__(self, n: int, plans: dict[int, Code], p: Params):
        self.n, self.plans, self.p, self.books = n, plans, p, {}

    def code(self, d: int) -> Code:
        if d not in self.plans:
            self.plans[d] = plan(self.n, d, self.p)
        return self.plans[d]

    def found(self, unit: np.ndarray, numbers: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(row, cap) of the unit vectors, by row, in the codes with these numbers."""
        code = self.code(unit.shape[1])
        step = max(1, min(512, (1 << 20) // (len(numbers) * max(code.blocks * code.words, code.words ** (code.blocks // 2)))))
        each = [decode(unit[k : k + step], code, numbers) for k in range(0, len(unit), step)]
        return np.concatenate([row + i * step for i, (row, _) in enumerate(each)]), np.concatenate([cap for _, cap in each])

    def of(self, unit: np.ndarray) -> list[np.ndarray]:
        """The sorted caps of each unit vector."""
        d, numbers = unit.shape[1], tuple(range(self.p.codes))
        self.books[d] = self.code(d), [codebook(d, self.code(d), i) for i in numbers]
        row, cap = self.found(unit, numbers)
        return [np.sort(c) for c in np.split(cap, np.cumsum(np.bincount(row, minlength=len(unit)))[:-1])]

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, 8) longs: the sides of SIGNS random planes that each vector lies on."""
        return np.packbits(unit.astype(np.float32) @ _planes(self.p.seed, unit.shape[1]) > 0, axis=1).view(np.int64)


def most_apart(p: Params, signs: int = SIGNS) -> int:
    """Of so many signs those in which the sketches of a pair at the threshold may differ."""
    share = np.arccos(p.threshold) / np.pi
    return int(np.ceil(signs * share + p.sigmas * np.sqrt(signs * share * (1 - share))))


def large_caps(caps: Caps, samples: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length the sorted caps that hold far more than SPLIT vectors by the sample, and the parts of each. It
    says only how the work is dealt out, not what is found."""
    out = {}
    size = sum(len(x) for x in samples.values())
    for d, x in samples.items():
        cap, hits = np.unique(caps.found(x, tuple(range(caps.p.codes)))[1], return_counts=True)
        parts = np.ceil(hits * (caps.n / size) / SPLIT).astype(np.int64)
        large = (hits >= 5) & (parts > 1)
        out[d] = cap[large], np.minimum(parts[large], MOST_PARTS)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    """Longs as even numbers below 2^31, alike for alike."""
    return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (x.astype(np.uint64) >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def cap_entries(vectors: DataFrame, caps: Caps, numbers: tuple[int, ...], parts: int, large: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(part, d, entries): each vector in each of its caps of these codes, packed as ENTRY by the part that compares the cap.
    A large cap is a bucket for each two of its parts."""

    def pack(rep: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        row, key = caps.found(unit, numbers)
        many, split = large.get(unit.shape[1], (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        if len(many):
            at = np.minimum(np.searchsorted(many, key), len(many) - 1)
            shares = np.where(many[at] == key, split[at], 1)
            if shares.sum() > MOST_ENTRIES and len(rep) > 1:
                for half in np.array_split(np.arange(len(rep)), 2):
                    yield from pack(rep[half], unit[half])
                return
            side = (_mixed(rep[row]) % shares.astype(np.uint64)).astype(np.int64)
            other = np.arange(shares.sum()) - np.repeat(np.cumsum(shares) - shares, shares)
            row, key, side = (np.repeat(x, shares) for x in (row, key, side))
            key = key + CAPS * (np.minimum(side, other) * MOST_PARTS + np.maximum(side, other))
        part = (_mixed(key) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        row, part = row[order], part[order]
        entries = np.empty(len(row), ENTRY)
        entries["key"], entries["rep"], entries["signs"] = key[order], rep[row], caps.signs(unit).view(np.uint64)[row]
        start = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(row) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(start, len(row)).astype(np.int32) * ENTRY.itemsize)
        data = pa.Array.from_buffers(pa.binary(), len(start), [None, offsets.buffers()[1], pa.py_buffer(entries)])
        yield pa.RecordBatch.from_arrays([pa.array(part[start].astype(np.int32)), pa.array(np.full(len(start), unit.shape[1], np.int32)), data], names=["part", "d", "entries"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, DECODED):
            sizes = np.diff(table.column(1).offsets.to_numpy())
            for d in np.unique(sizes):
                rows = np.flatnonzero(sizes == d)
                step = max(64, DECODED * 64 // max(64, int(d)))
                for lo in range(0, len(rows), step):
                    part = rows[lo : lo + step]
                    yield from pack(table.column(0).to_numpy()[part], _matrix(table.column(1), part))

    return vectors.select("rep", "embedding").mapInArrow(send, "part int, d int, entries binary")


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, size = [], 0
    if size:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First signs in which sketches differ; the first axis holds the longs."""
    out = np.bitwise_count(a[0] ^ b[0])
    for i in range(1, FIRST_SIGNS // 64):
        out += np.bitwise_count(a[i] ^ b[i])
    return out


def _near(a: np.ndarray, b: np.ndarray, p: Params) -> np.ndarray:
    """Whether sketches are near in all signs; the last axis holds the longs."""
    return np.bitwise_count(a ^ b).sum(axis=-1) <= most_apart(p)


def _labels(rep: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches by the links a-b."""
    label = rep.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        if (new == label).all():
            return label
        label = new


def _searched(rep: np.ndarray, signs: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(label, rep) of the rows of one large bucket that are near others. A row that was reached is compared only with
    those that were not, so a large group of near copies takes little more than one comparison a row."""
    order = np.argsort(rep, kind="stable")
    rep, signs, most = rep[order], signs[order], most_apart(p, FIRST_SIGNS)
    label, linked = rep.copy(), np.zeros(len(rep), bool)
    rest, theirs = np.arange(len(rep)), np.ascontiguousarray(signs[:, : FIRST_SIGNS // 64].T)
    while len(rest):
        first, rest, theirs = rest[0], rest[1:], theirs[:, 1:]
        waiting = [np.array([first])]
        while waiting and len(rest):
            rows = waiting.pop()
            near = np.zeros(len(rest), bool)
            for row in rows[:16]:
                at = np.flatnonzero(_apart(signs[row], theirs) <= most)
                near[at[_near(signs[row], signs[rest[at]], p)]] = True
            if len(rows) > 16:
                waiting.append(rows[16:])
            if near.any():
                waiting.append(rest[near])
                linked[first] = linked[rest[near]] = True
                label[rest[near]] = rep[first]
                rest, theirs = rest[~near], theirs[:, ~near]
    return label[linked], rep[linked]


def near_labels(entries: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(label, rep), each pair once: for each bucket (key) of the entries the rows joined to others by near sketches, with
    the smallest id among them. Buckets of about one size are compared together."""
    order = np.argsort(entries["key"], kind="stable")
    key = entries["key"][order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(start, len(key)))
    start, size = start[size > 1], size[size > 1]
    labels, reps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def take(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = entries[order[at]]
        return rows["rep"], rows["signs"]

    most = most_apart(p, FIRST_SIGNS)

    for i in np.flatnonzero(size > ALL_PAIRS):
        label, rep = _searched(*take(np.arange(start[i], start[i] + size[i])), p)
        labels.append(label)
        reps.append(rep)
    wide = np.array([2, 3, 4, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384, 448, ALL_PAIRS])
    kind = np.searchsorted(wide, size)
    for k in np.unique(kind[size <= ALL_PAIRS]):
        groups, width = np.flatnonzero(kind == k), int(wide[k])
        strip = width if width < 24 else width // 4
        step = max(1, (1 << 17) // (strip * width))
        for lo in range(0, len(groups), step):
            part, place = groups[lo : lo + step], np.arange(width)
            here = place < size[part, None]
            rep, signs = take(np.where(here, start[part, None] + place, start[part, None]).reshape(-1))
            begin = np.ascontiguousarray(signs[:, : FIRST_SIGNS // 64].T).reshape(-1, len(part), width)
            one, two = [], []
            for s in range(0, width, strip):  # each row with the later ones
                near = _apart(begin[:, :, s : s + strip, None], begin[:, :, None, s:]) <= most
                near &= place[s:] > place[s : s + strip, None]
                near &= here[:, None, s:]
                found = np.flatnonzero(near)
                group, at = np.divmod(found, strip * (width - s))
                one.append(group * width + s + at // (width - s))
                two.append(group * width + s + at % (width - s))
            a, b = np.concatenate(one), np.concatenate(two)
            near = _near(signs[a], signs[b], p)
            a, b = a[near], b[near]
            if len(a):
                linked = np.unique(np.concatenate([a, b]))
                labels.append(_labels(rep, a, b)[linked])
                reps.append(rep[linked])
    label, rep = np.concatenate(labels), np.concatenate(reps)
    order = np.lexsort((rep, label))
    label, rep = label[order], rep[order]
    new = np.append(np.ones(min(1, len(rep)), bool), (label[1:] != label[:-1]) | (rep[1:] != rep[:-1]))
    return label[new], rep[new]


def near_rows(entries: DataFrame, parts: int, p: Params) -> DataFrame:
    """(d, label, rep) of the buckets of ``entries``; a task holds the rows of its part."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for d, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                held.setdefault(d, []).append(np.frombuffer(data.as_buffer(), ENTRY))
        for d in sorted(held):
            label, rep = near_labels(np.concatenate(held.pop(d)), p)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rep), d, np.int32)), pa.array(label), pa.array(rep)], names=["d", "label", "rep"])

    return entries.repartitionById(parts, F.col("part")).mapInArrow(meet, "d int, label long, rep long")


KEY = ["d", "cap", "b1", "b2"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a group (KEY) of the sorted rows ends; at most one group more than a batch is held."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        table = pa.Table.from_batches([*waiting, batch])
        edge = np.flatnonzero(_edges(table)[1:])
        if len(edge):
            yield table.slice(0, int(edge[-1]) + 1).combine_chunks()
            table = table.slice(int(edge[-1]) + 1).combine_chunks()
        waiting = table.to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def _edges(table: pa.Table) -> np.ndarray:
    """Where a row begins a group."""
    keys = np.stack([table.column(c).to_numpy() for c in KEY])
    return np.append(np.ones(min(1, table.num_rows), bool), (keys[:, 1:] != keys[:, :-1]).any(axis=0))


def _linked(rep: np.ndarray, x: np.ndarray, side: np.ndarray, across: bool, p: Params) -> tuple[np.ndarray, np.ndarray] | None:
    """(rows, links): the rows of a group that have links, and which of these rows link with which."""
    linked = x @ x.T >= p.threshold
    linked &= rep[:, None] != rep[None, :]
    if across:
        linked &= side[:, None] != side[None, :]
    rows = np.flatnonzero(linked.any(axis=1))
    return (rows, linked[np.ix_(rows, rows)]) if len(rows) else None


def _new_links(rep: np.ndarray, copies: np.ndarray, linked: np.ndarray, caps: list[np.ndarray], cap: int):
    """(rep, links, root) of the rows with links that no smaller shared cap has already given."""
    before = [c[: np.searchsorted(c, cap)] for c in caps]
    names, at = np.unique(np.concatenate(before), return_inverse=True)
    who = np.repeat(np.arange(len(rep)), [len(c) for c in before])
    for lo in range(0, len(names), 4096):
        part = (at >= lo) & (at < lo + 4096)
        holds = np.zeros((len(rep), min(4096, len(names) - lo)), np.float32)
        holds[who[part], at[part] - lo] = 1
        linked = linked & (holds @ holds.T == 0)
    keep = np.flatnonzero(linked.any(axis=1))
    if not len(keep):
        return None
    linked, label = linked[np.ix_(keep, keep)], rep[keep]
    while True:
        near = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, near)
        if (new == label).all():
            break
        label = new
    return rep[keep], linked @ copies[keep], label


def bucket_links(rows: DataFrame, p: Params) -> DataFrame:
    """(rep, links, root) from rows(d, cap, b1, b2, side, rep, copies, embedding, caps), compared per group (KEY).

    Rows come sorted; one group of at most two blocks is held at a time. A link is counted in the smallest of the caps
    that its ends share.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            rep, copies, side, cap = (table.column(c).to_numpy() for c in ("rep", "copies", "side", "cap"))
            vectors, lists = (_one_chunk(table.column(c)) for c in ("embedding", "caps"))
            across = table.column("b1").to_numpy() != table.column("b2").to_numpy()
            edge = [*np.flatnonzero(_edges(table)), table.num_rows]
            out = []
            for a, b in zip(edge, edge[1:], strict=False):
                if (got := _linked(rep[a:b], _matrix(vectors.slice(a, b - a)), side[a:b], across[a], p)) is not None:
                    at = a + got[0]
                    out.append(_new_links(rep[at], copies[at], got[1], [lists[int(i)].values.to_numpy() for i in at], cap[a]))
            if out := [o for o in out if o is not None]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], ["rep", "links", "root"])

    keyed = rows.select(*KEY, "side", "rep", "copies", "embedding", "caps").repartition(*KEY).sortWithinPartitions(*KEY)
    return keyed.mapInArrow(compare, "rep long, links long, root long")


def _one_chunk(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def bucket_rows(near: DataFrame) -> DataFrame:
    """(d, cap, b1, b2, side, rep): the rows(d, cap, rep), those of large caps in blocks, each two of them once."""
    large = near.groupBy("d", "cap").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > BLOCK)
    large = large.select("d", "cap", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("parts"))
    each = near.join(large, ["d", "cap"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    each = each.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    each = each.select("d", "cap", "rep", "side", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return each.select("d", "cap", F.least("side", "other").alias("b1"), F.greatest("side", "other").alias("b2"), "side", "rep")


def sampled(reps: DataFrame, p: Params) -> dict[int, np.ndarray]:
    """The unit vectors of each length of a sample of at most ``Params.sample`` vectors."""
    found = _one_chunk(reps.select("rep", "embedding").orderBy(F.xxhash64("rep"), "rep").limit(p.sample).toArrow().column("embedding"))
    sizes = np.diff(found.offsets.to_numpy())
    return {int(d): _matrix(found, np.flatnonzero(sizes == d)) for d in np.unique(sizes)}


def near_in_caps(reps: DataFrame, n: int, p: Params) -> DataFrame:
    """(d, cap, rep): the n vectors that share a cap with one of a near sketch, with their labels as ``cap``.

    Rounds over some of the codes each keep the rows that are shuffled at once within ROUND_SHARE times the vectors.
    """
    spark = reps.sparkSession
    samples = sampled(reps, p)
    caps = Caps(n, {d: plan(n, d, p, x) for d, x in samples.items()}, p)
    large = large_caps(caps, samples)
    tried = sum(len(x) for x in samples.values())
    sent = n * ENTRY.itemsize * sum(len(caps.found(x, tuple(range(p.codes)))[0]) for x in samples.values()) / max(1, tried)
    vectors = n * 4 * sum(x.size for x in samples.values()) / max(1, tried)
    rounds = min(p.codes, int(sent / max(ROUND_SHARE * vectors, LEAST_ROUND)) + 1)
    parts = max(shuffle_partitions(spark), int(sent / rounds / TASK_BYTES) + 1)
    near = []
    for k in range(rounds):
        entries = cap_entries(reps, caps, tuple(range(k, p.codes, rounds)), parts, large)
        near.append(stash(near_rows(entries, parts, p), "near"))
    return functools.reduce(DataFrame.union, near).select("d", F.col("label").alias("cap"), "rep").distinct()


def without_parts(near: DataFrame) -> DataFrame:
    """The rows(d, cap, rep) without caps whose rows are all in the smallest cap of the row that gave this one its name: any
    two of its rows meet there. A group of near copies keeps few of its many labels."""
    least = near.groupBy("d", F.col("rep").alias("cap")).agg(F.min("cap").alias("least")).filter("least < cap")
    there = near.join(least, ["d", "cap"]).join(near.select("d", F.col("cap").alias("least"), "rep"), ["d", "least", "rep"], "left_semi")
    there = there.groupBy("d", "cap").agg(F.count(F.lit(1)).alias("shared"))
    whole = near.groupBy("d", "cap").agg(F.count(F.lit(1)).alias("size")).join(there, ["d", "cap"]).filter("size = shared")
    return near.join(whole, ["d", "cap"], "left_anti")


def _same() -> list[Column]:
    """Two hashes that stand for an equal vector where rows find theirs again."""
    return [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]


def near_components(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", params: Params = Params()) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Links join vectors whose cosine (double precision) is at least the threshold; pairs at the threshold itself
    are missed with a chance of about Params.missed, as estimated on random pairs, closer ones with a smaller one, and
    no link below it is made.
    Null vectors, zero vectors and vectors that hold null or non-finite numbers link with nothing, nor do vectors
    of different lengths. Equal vectors are joined first and compared once; each counts the others as links. Ids
    should be unique: rows that share one share its links. A null id sorts first and comes back as null. An empty
    table gives no rows; other columns are ignored.

    A link is counted in the smallest label that its ends share, so n_links needs no list of pairs; buckets hand on
    a row per vector and the roots of their links. Labels above BLOCK rows are compared in blocks. A sample of at most
    ``Params.sample`` vectors sets the height of the caps and which of them are dealt out in parts; which links are found
    does not hang on how it turns out.
    """
    p = params
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    ok = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    good = rows.filter(F.coalesce(ok, F.lit(False)))
    with freed_shuffles(vectors.sparkSession):
        reps = stash(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
        near = stash(near_in_caps(reps, reps.count(), p), "labels")
        near = stash(without_parts(near), "labels")
        # only vectors with a label are sent to where they meet
        lists = near.groupBy("d", "rep").agg(F.sort_array(F.collect_list("cap")).alias("caps"))
        held = reps.select(F.size("embedding").alias("d"), "rep", "copies", "embedding").join(lists, ["d", "rep"])
        found = cut(bucket_links(bucket_rows(near).join(held, ["d", "rep"]), p))
    merged = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    groups = found.groupBy("rep").agg(F.sum("links").alias("links")).join(merged.withColumnRenamed("id", "rep"), "rep", "full")
    # most vectors are alone and have no equal: they need no row in either table
    twins = reps.filter("copies > 1").select(*_same(), "rep", "copies")
    linked = good.select("vec_id", *_same()).join(twins, ["h1", "h2"], "left").select("vec_id", F.coalesce("rep", "vec_id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies"))
    linked = linked.join(groups, "rep", "left").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = rows.filter(~F.coalesce(ok, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    real = lambda c: F.nullif(F.col(c), F.lit(NO_ID)).alias(c)
    return linked.union(alone).select(real("vec_id"), "n_links", real("component_id"), (F.col("vec_id") == F.col("component_id")).alias("kept"))
