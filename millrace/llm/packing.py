"""Packing documents into as few sequences as can be, by a configuration linear program over the histogram of lengths.

The program has a variable for each way to fill a sequence (a configuration) and a constraint for each length: enough copies
of it. Multiplicative weights solve it: each length has a price, a knapsack by dynamic programming finds the configuration
of most worth, so much of it is taken as covers a share of one of its lengths, and the prices of its lengths fall. A round looks at the
lengths of the highest price for a token (partial pricing); rounds over all lengths give a lower bound. The solution
is rounded to whole sequences, and what is then left over goes by best fit, longest first, into open sequences.

All of this works on counts of at most ``capacity`` lengths, on the driver. The pieces stay where they are: each knows its number
among pieces of its length (a count per task plus sums over tasks), and a table of runs says where that number goes.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import bounded_batches, stash, text_of
from millrace.llm.token_ids import encoder


@dataclass(frozen=True)
class Params:
    """``priced`` lengths take part in a round's knapsack; prices fall by exp(-fall) while a length is covered once. Only
    configurations that are ``full`` to that share are rounded to whole sequences, so that best fit finds short pieces for gaps."""

    capacity: int = 4096
    end_id: int = 1
    priced: int = 64
    rounds: int = 20_000
    step: float = 0.5
    fall: float = 0.25
    full: float = 0.999
    seed: int = 7


Pattern = tuple[tuple[int, int], ...]


@dataclass
class Plan:
    """(sequences, pattern) pairs; a pattern lists (length, copies) in the order in which they lie in a sequence."""

    patterns: list[tuple[int, Pattern]] = field(default_factory=list)
    lower_bound: int = 0
    from_program: int = 0

    @property
    def sequences(self) -> int:
        return sum(n for n, _ in self.patterns)


def knapsack(lengths: np.ndarray, worth: np.ndarray, bounds: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most worth of at most ``bounds`` copies of each length within the capacity, and the copies."""
    items = []
    for k, (size, most) in enumerate(zip(lengths.tolist(), np.minimum(bounds, capacity // lengths).tolist(), strict=True)):
        many = 1
        while most > 0:
            many = min(many, most)
            items.append((k, many, size * many))
            most, many = most - many, many * 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)
    for i, (k, many, size) in enumerate(items):
        with_it = best[:-size] + worth[k] * many
        np.greater(with_it, best[size:] + 1e-12, out=taken[i, size:])
        np.maximum(best[size:], with_it, out=best[size:])
    copies, room = np.zeros(len(lengths), np.int64), capacity
    for i in range(len(items) - 1, -1, -1):
        if taken[i, room]:
            copies[items[i][0]] += items[i][1]
            room -= items[i][2]
    return float(best[capacity]), copies


def solve(lengths: np.ndarray, counts: np.ndarray, p: Params) -> tuple[list[tuple[float, np.ndarray, np.ndarray]], int]:
    """(amount, places of lengths, copies) of each configuration, together a cover of all counts where the rounds suffice, and a
    lower bound for the number of sequences."""
    step = min(p.step, max(1 / 64, len(lengths) / 1000))  # few lengths: cheap rounds, so smaller steps
    tie = np.random.default_rng(p.seed).random(len(lengths))
    log_price = np.zeros(len(lengths))  # of a token, against 1 / capacity
    covered = np.zeros(len(lengths))
    need = counts.astype(np.float64)
    bound, taken = max(-(-int((lengths * counts).sum()) // p.capacity), int(counts[2 * lengths > p.capacity].sum())), []
    checks = {int(p.rounds * x) for x in (0.002, 0.01, 0.05, 0.25)}
    for k in range(p.rounds):
        open_ = np.flatnonzero(covered < need * (1 - 1e-9))
        if k in checks or not len(open_):
            prices = np.exp(log_price) * lengths / p.capacity
            most, _ = knapsack(lengths, prices, counts, p.capacity)
            bound = max(bound, int(np.ceil(float((prices * counts).sum()) / most * (1 - 1e-9))))
        if not len(open_):
            break
        # The lengths least covered so far; longer ones first among them, some at random to fill gaps.
        dear = open_[np.lexsort((tie[open_], -log_price[open_]))[: p.priced]]
        worth = np.exp(log_price[dear] - log_price[dear].max()) * lengths[dear] / p.capacity
        _, copies = knapsack(lengths[dear], worth, counts[dear], p.capacity)
        used = np.flatnonzero(copies)
        at, copies = dear[used], copies[used]
        share = need[at] / copies
        amount = min(step * float(share.min()), float(((need[at] - covered[at]) / copies).max()))
        covered[at] += amount * copies
        log_price[at] -= p.fall * amount / share
        taken.append((amount, at, copies))
    return taken, bound


def _best_fit(plan: Plan, left: dict[int, int], capacity: int) -> None:
    """Put the lengths that are left over into the plan's sequences with room, tightest first, and into new ones."""
    open_: dict[int, list[tuple[int, Pattern]]] = {}
    for n, pattern in plan.patterns:
        open_.setdefault(capacity - sum(a * b for a, b in pattern), []).append((n, pattern))
    rooms = sorted(open_)

    def add(n: int, pattern: Pattern, room: int) -> None:
        if n:
            if room not in open_:
                bisect.insort(rooms, room)
            open_.setdefault(room, []).append((n, pattern))

    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                many, pattern = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[k]
            else:  # new sequences
                room, pattern = capacity, ()
                many = -(-n // (capacity // length))
            each = room // length
            full = min(many, n // each)
            add(full, (*pattern, (length, each)), room - each * length)
            n -= full * each
            if full < many:
                rest = min(n, each)
                one = 1 if rest else 0
                add(one, (*pattern, (length, rest)), room - rest * length)
                add(many - full - one, pattern, room)
                n -= rest
    plan.patterns = [x for room in rooms for x in open_[room]]


def plan_sequences(histogram: dict[int, int], params: Params = Params()) -> Plan:
    """A plan that holds every piece of the histogram (length -> pieces) exactly once.

    Pieces as long as a sequence stand alone. The configurations of the program become as many whole sequences as their
    amount rounded up, as long as there are pieces for them; the others follow by best fit.
    """
    p = params
    left = {length: n for length, n in histogram.items() if n}
    plan = Plan()
    if whole := left.pop(p.capacity, 0):
        plan.patterns.append((whole, ((p.capacity, 1),)))
    if left:
        lengths = np.array(sorted(left), np.int64)
        counts = np.array([left[x] for x in lengths.tolist()], np.int64)
        taken, bound = solve(lengths, counts, p)
        rest = counts.copy()
        for amount, at, copies in sorted(taken, key=lambda x: -int((lengths[x[1]] * x[2]).sum())):  # the fullest first
            n = min(int(np.ceil(amount)), int((rest[at] // copies).min()))
            if n > 0 and (lengths[at] * copies).sum() >= p.full * p.capacity:
                rest[at] -= n * copies
                plan.patterns.append((n, tuple(zip(lengths[at].tolist(), copies.tolist(), strict=True))))
        plan.lower_bound, plan.from_program = bound, plan.sequences - whole
        _best_fit(plan, {x: n for x, n in zip(lengths.tolist(), rest.tolist(), strict=True) if n}, p.capacity)
    plan.lower_bound += whole
    return plan


@dataclass(frozen=True)
class Runs:
    """Where the pieces of each length go: from piece ``first`` on (lengths one after the other), ``copies`` a sequence."""

    base: np.ndarray  # by length: the number of the first piece of that length
    first: np.ndarray
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, plan: Plan, histogram: dict[int, int], capacity: int) -> Runs:
        counts = np.zeros(capacity + 2, np.int64)
        for length, n in histogram.items():
            counts[length + 1] = n
        base = np.cumsum(counts)[:-1]
        at, rows, sequence = base.copy(), [], 0
        for n, pattern in plan.patterns:
            offset = 0
            for length, copies in pattern:
                rows.append((at[length], copies, sequence, offset))
                at[length] += n * copies
                offset += length * copies
            sequence += n
        if not np.array_equal(at[:-1], base[1:]):
            raise AssertionError("the plan does not hold every piece once")
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(base, *table.T)

    def place(self, number: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by their number among those of their length."""
        number = number + self.base[length]
        k = np.searchsorted(self.first, number, side="right") - 1
        inside = number - self.first[k]
        return self.sequence[k] + inside // self.copies[k], self.offset[k] + inside % self.copies[k] * length


def _cut(file, params: Params, keep_ids: bool):
    """A map over (id, text): the pieces of each document, each with its number among the task's pieces of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file.value).ids
        task = TaskContext.get().partitionId()
        met = [0] * (params.capacity + 1)
        end = params.end_id.to_bytes(4, "little")
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows, source = [], []
            for i, raw in enumerate(encode(texts)):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * params.capacity)):
                    ids = raw[at : at + 4 * params.capacity]
                    length = len(ids) // 4
                    rows.append((piece, at // 4, length, zlib.crc32(ids), task, met[length], *([ids] if keep_ids else [])))
                    source.append(i)
                    met[length] += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *([pa.binary()] if keep_ids else [])]
            names = ["piece", "start", "length", "ids_crc32", "task", "number", *(["ids"] if keep_ids else [])]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source, pa.int32())), *columns], names=[batch.schema.names[0], *names])

    return run


def _places(runs):
    """A map over pieces: their sequence and offset in place of task, number and earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Runs = runs.value
        for batch in batches:
            number = batch.column("number").to_numpy() + batch.column("earlier").to_numpy()
            found = table.place(number, batch.column("length").to_numpy())
            kept = [n for n in batch.schema.names if n not in ("number", "earlier")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *[pa.array(x, pa.int64()) for x in found]], names=[*kept, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: bytes, *, id_col: str = "doc_id", text_col: str = "text", params: Params = Params(), keep_ids: bool = False) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, sequence_id, offset; with ``keep_ids`` also ids (binary,
    little-endian unsigned 32-bit).

    A document is its text's ids, without special tokens added, and ``end_id``; null and empty texts are that id alone.
    Documents longer than a sequence are cut into whole sequences and a rest. Repeated rows and ids are documents of their own;
    other columns are ignored; an empty table gives no rows. Strings of special tokens in a text are what the file says.

    Pieces are written once, narrow unless ids are kept; counts by task and length are the only other thing that is gathered.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`"), text_of(f"`{text_col}`").alias("_text"))
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), ("task", T.IntegerType()), ("number", T.LongType())]
    fields += [("ids", T.BinaryType())] if keep_ids else []
    schema = T.StructType([rows.schema.fields[0], *[T.StructField(n, t) for n, t in fields]])
    pieces = stash(rows.mapInArrow(_cut(spark.sparkContext.broadcast(tokenizer), params, keep_ids), schema), "pieces")

    counts = stash(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most a row a length
    plan = plan_sequences(histogram, params)
    runs = Runs.of(plan, histogram, params.capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    counts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    numbered = pieces.join(counts, ["task", "length"]).select(f"`{id_col}`", *[n for n, _ in fields if n != "task"], "earlier")
    schema = T.StructType([f for f in numbered.schema.fields if f.name not in ("number", "earlier")] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(_places(spark.sparkContext.broadcast(runs)), schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) from ``pack(..., keep_ids=True)``: the pieces of each sequence one after the other.

    A group has at most as many pieces as a sequence has tokens."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexed = F.array_join(F.transform(joined, lambda x: F.hex(x.ids)), "")
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(hexed).alias("ids"))
