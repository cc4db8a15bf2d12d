"""Product codes of vectors: one byte for each of four parts, with codebooks fitted by exact integer rounds.

Components become integers, so sums, means and distances are exact and no result hangs on the order of rows or on the
number of tasks. The nearest entry is found in two steps. A float32 matrix product of a batch with the codebook gives every
distance up to an error that is bounded rigorously; entries whose interval reaches below the smallest upper end stay in the
race (mostly one), and only these are evaluated again in int64, ties going to the lower index.

Each round is one map over the vectors and an aggregate of 256 sums a part and task; what comes to the driver is a codebook
of 256 vectors. The vectors themselves are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import bounded_batches, stash

#: Vectors assigned at once, and pairs (vector, entry) evaluated exactly at once.
BLOCK, PAIRS = 2048, 1 << 16
#: Groups of labels up to which their sums are broadcast.
BROADCAST_LABELS = 100_000
#: Unit roundoff of float32 and of float64.
_U32, _U64 = 2.0**-24, 2.0**-53


@dataclass(frozen=True)
class Params:
    """A code has one byte a part, so at most 256 entries; components are floor(scale * x)."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


@dataclass(frozen=True)
class Codebooks:
    """One array (entries, width) of int64 for each part."""

    parts: tuple[np.ndarray, ...]
    scale: int

    @property
    def dim(self) -> int:
        return sum(p.shape[1] for p in self.parts)

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for p in self.parts for x in p.ravel().tolist()).encode()).hexdigest()


def limit(dim: int) -> int:
    """Scaled components are held within plus or minus this, so that no sum of squares of ``dim`` differences leaves int64.

    2**26 for 256 dimensions and 2**24 for 4,096, that is components of 65,536 and 16,384 at a scale of 1,024.
    """
    return 1 << min(30, (62 - max(dim, 1).bit_length()) // 2 - 1)


def integers(flat: np.ndarray, offsets: np.ndarray, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the vectors that lie one after the other in ``flat``, shorter ones filled up with zeros."""
    most = float(limit(dim))
    scaled = np.clip(np.floor(flat.astype(np.float64) * scale), -most, most).astype(np.int64)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), dim), np.int64)
    if len(lengths) and (lengths == dim).all():
        out[:] = scaled[offsets[0] : offsets[-1]].reshape(-1, dim)
    else:
        for i, (a, n) in enumerate(zip(offsets[:-1].tolist(), lengths.tolist(), strict=True)):
            out[i, :n] = scaled[a : a + n]
    return out


class Screen:
    """Exact nearest entries of one codebook by float32 screening."""

    def __init__(self, entries: np.ndarray):
        # Of equal entries only the first can be nearest.
        _, first = np.unique(entries, axis=0, return_index=True)
        self.index = np.sort(first)
        self.entries = entries[self.index]
        self.f32 = np.ascontiguousarray(self.entries.astype(np.float32).T)
        squares = (self.entries.astype(np.int64) ** 2).sum(axis=1)
        self.squares = squares.astype(np.float64)
        self.norms = np.sqrt(self.squares) * (1 + 4 * _U64)
        n = entries.shape[1] + 3  # products and sums, and both factors rounded to float32
        self.gamma = n * _U32 / (1 - n * _U32)
        self.evaluated = 0

    def intervals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle and radius of |c|^2 - 2xc for all rows x and entries c: the exact value lies within.

        |fl(xc) - xc| <= gamma |x||c| whatever the order of the sum (Cauchy-Schwarz on the sum of absolute products); the
        float64 steps after it add a few roundoffs of the sizes involved. Integers up to 2**30 neither over- nor underflow.
        """
        product = (x.astype(np.float32) @ self.f32).astype(np.float64)
        norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + (x.shape[1] + 4) * _U64)
        sizes = norms[:, None] * self.norms[None, :]
        middle = self.squares[None, :] - 2 * product
        radius = 2 * self.gamma * (1 + 8 * _U64) * sizes + 8 * _U64 * (self.squares[None, :] + 2 * np.abs(product))
        return middle, radius

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row, the lower index where distances are equal."""
        index, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for start in range(0, len(x), BLOCK):
            block = x[start : start + BLOCK]
            middle, radius = self.intervals(block)
            reach = (middle + radius).min(axis=1)
            rows, cols = np.nonzero(middle - radius <= reach[:, None])
            distance = np.empty(len(rows), np.int64)
            for p in range(0, len(rows), PAIRS):
                r, c = rows[p : p + PAIRS], cols[p : p + PAIRS]
                distance[p : p + PAIRS] = ((block[r] - self.entries[c]) ** 2).sum(axis=1)
            self.evaluated += len(rows)
            order = np.lexsort((cols, distance, rows))
            first = order[np.unique(rows[order], return_index=True)[1]]
            index[start : start + len(block)] = self.index[cols[first]]
            error[start : start + len(block)] = distance[first]
        return index, error


def _split(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def _vectors(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """The integers of an Arrow column of float lists without nulls."""
    flat = column.values.to_numpy(zero_copy_only=False)
    return integers(flat, column.offsets.to_numpy(), dim, scale)


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is not null and holds neither nulls nor values that are not finite."""
    v = F.col(f"`{vec_col}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    return vectors.filter(v.isNotNull() & ~F.exists(v, bad))


def _sums(books: Codebooks):
    """A map over vectors: for each part and entry that was nearest to any, the number of vectors and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        screens = [Screen(p) for p in books.parts]
        counts = [np.zeros(len(p), np.int64) for p in books.parts]
        totals = [np.zeros(p.shape, np.int64) for p in books.parts]
        for batch in batches:
            x = _vectors(batch.column(0), books.dim, books.scale)
            for k, part in enumerate(_split(x, len(books.parts))):
                nearest, _ = screens[k].nearest(part)
                counts[k] += np.bincount(nearest, minlength=len(counts[k]))
                order = np.argsort(nearest, kind="stable")
                used, at = np.unique(nearest[order], return_index=True)
                if len(used) and part.shape[1]:
                    totals[k][used] += np.add.reduceat(part[order], at, axis=0)
        rows = [(k, e, int(counts[k][e]), totals[k][e].tolist()) for k in range(len(counts)) for e in np.flatnonzero(counts[k]).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=["part", "entry", "n", "total"]
        )

    return run


def start(vectors: DataFrame, *, id_col: str, vec_col: str, params: Params = Params()) -> Codebooks | None:
    """The codebooks before any round: the parts of the usable vectors with the smallest ids; None where there is none."""
    rows = usable(vectors, vec_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    longest = rows.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        return None
    dim = -(-longest // params.parts) * params.parts
    first = [r.vec for r in rows.orderBy(F.col("id").asc_nulls_last(), "vec").limit(params.entries).collect()]
    offsets = np.cumsum([0, *map(len, first)])
    x = integers(np.array([v for vec in first for v in vec], np.float64), offsets, dim, params.scale)
    return Codebooks(tuple(_split(x, params.parts)), params.scale)


def train(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", params: Params = Params()) -> Codebooks | None:
    """Codebooks after ``params.rounds`` rounds over all usable vectors; None where there is none.

    A round assigns every part to its nearest entry, then replaces each entry that was nearest to any by the floor of their
    mean; the others stay. Vectors need not have one length: the longest, made up to a multiple of the parts, counts, and
    shorter ones end in zeros. Rows with a null id come last among the starting entries; of rows with one id the smaller
    vector comes first. Scaled components beyond ``limit(dim)`` are taken as that limit.
    """
    bounded_batches(vectors.sparkSession)
    books = start(vectors, id_col=id_col, vec_col=vec_col, params=params)
    if books is None:
        return None
    rows = usable(vectors, vec_col).select(F.col(f"`{vec_col}`").alias("vec"))
    for _ in range(params.rounds):
        partial = rows.mapInArrow(_sums(books), "part int, entry int, n long, total array<long>")
        width = books.parts[0].shape[1]
        sums = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width)])
        new = [p.copy() for p in books.parts]
        for row in sums.collect():  # at most one row an entry
            new[row.part][row.entry] = np.array([row[f"s{i}"] // row.n for i in range(width)], np.int64)
        books = Codebooks(tuple(new), books.scale)
    return books


def _codes(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        screens = [Screen(p) for p in books.parts]
        for batch in batches:
            x = _vectors(batch.column(0), books.dim, books.scale)
            index, error = zip(*(screens[k].nearest(part) for k, part in enumerate(_split(x, len(screens)))), strict=True)
            codes = [row.tobytes().hex() for row in np.stack(index, axis=1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(codes, pa.string()), pa.array(sum(error), pa.int64())], names=[*batch.schema.names[1:], "code", "error"])

    return run


def encode(vectors: DataFrame, books: Codebooks | None, *, id_col: str = "vec_id", vec_col: str = "embedding", also: tuple[str, ...] = ()) -> DataFrame:
    """The id, the columns ``also``, code (two hex digits a part) and error (squared distance) of every usable vector.

    Rows whose vector is null or holds nulls or values that are not finite are left out; an empty table gives no rows.
    Repeated rows are coded each. A vector longer than the codebooks' dimension is an error; shorter ones end in zeros.
    """
    bounded_batches(vectors.sparkSession)
    rows = usable(vectors, vec_col).select(F.col(f"`{vec_col}`").alias("vec"), *[F.col(f"`{c}`") for c in (id_col, *also)])
    schema = T.StructType([*rows.schema.fields[1:], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_codes(books), schema)


def decode(codes: DataFrame, books: Codebooks, *, code_col: str = "code") -> DataFrame:
    """``codes`` plus ``vector``: the entries that a code names, one after the other, divided by the scale.

    A null code gives a null vector. The codebooks travel as literals of at most ``entries`` vectors.
    """
    parts = []
    for k, book in enumerate(books.parts):
        place = F.conv(F.substring(f"`{code_col}`", 2 * k + 1, 2), 16, 10).cast("int")
        entries = F.array(*[F.array(*[F.lit(x / books.scale) for x in row]) for row in book.tolist()])
        parts.append(F.get(entries, place))
    return codes.withColumn("vector", F.concat(*parts))


def with_group_error(coded: DataFrame, *, label_col: str = "label") -> DataFrame:
    """``coded`` plus ``label_error``: the error summed over all rows of the same label, nulls being one label.

    The coded rows are written first (they are narrow), so that vectors are coded once. Sums are added up per task before
    they are shuffled; they are broadcast where they are few, else joined, which Spark splits where a label is frequent.
    A sum beyond a long is null.
    """
    coded = stash(coded, "codes")
    sums = stash(coded.groupBy(F.col(f"`{label_col}`").alias("_label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    few = sums.count() <= BROADCAST_LABELS
    return coded.join(F.broadcast(sums) if few else sums, F.col(f"`{label_col}`").eqNullSafe(F.col("_label")), "left").drop("_label")
