"""Cheapest repair of the turn structure of conversations, by a weighted automaton that is determinised as it is needed.

A conversation's role initials have to spell ``(s?(ua)+)?``. The automaton that accepts this has four states (start, after
s, u, a); edits are its weighted arcs. Read from the last row to the first, every set of equal suffixes has a vector of four
costs to the end. Taken relative to its least entry, only a few dozen different vectors occur: they are the states of the
deterministic automaton, found when first met and kept in a transition table (state, symbol) -> (state, cost). The scan of a
conversation is then one table look-up a row and gives the cost; walking the scan's states back again, along arcs that are
tight (their cost is the difference of the two vectors), gives the edits.

Spark orders, groups and shuffles. Symbols (one character a row) are gathered in two steps, first within a range partition,
then within a conversation, so that a conversation of very many rows is one string of as many characters, like its audit.
Texts are shuffled once and stream past in order, one at a time, beside their conversation's audit.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, shuffle_partitions, stash

INF = 1 << 40
#: Automaton states; the index of the role whose output leads there.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The only role that may follow each state, besides a kept ``s`` at the start.
NEXT = (USER, USER, ASSISTANT, USER)
#: Role initials; the last stands for any other.
INITIALS = "suao"
#: One letter a row: the place of its initial times four plus that of its fault (none, truncated, blank, duplicate).
SYMBOLS = "abcdefghijklmnop"
#: Code points of a text by which rows of one turn and role are ordered before their hash decides.
HEAD = 64


@dataclass(frozen=True)
class Costs:
    """Costs of the edits; keeping a row costs nothing, blank and duplicate rows can only be deleted."""

    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


class Determinised:
    """The deterministic automaton of one set of costs. Its table grows while conversations are scanned."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        self.vectors: list[tuple[int, ...]] = []
        self._ids: dict[tuple[int, ...], int] = {}
        self._step: dict[tuple[int, str], tuple[int, int]] = {}
        self._edits: dict[tuple[int, str, int], tuple[str, int]] = {}
        end = [0 if q in (START, ASSISTANT) else INF for q in range(4)]
        self.end, self.end_cost = self._state(self._closed(end))

    def _state(self, vector: list[int]) -> tuple[int, int]:
        least = min(vector)
        normal = tuple(x - least for x in vector)
        if normal not in self._ids:
            self._ids[normal] = len(self.vectors)
            self.vectors.append(normal)
        return self._ids[normal], least

    def _closed(self, vector: list[int]) -> list[int]:
        """Costs where rows may also be inserted first: two at most are of use, as a third leads back."""
        for _ in range(2):
            vector = [min(v, self.costs.insert + vector[NEXT[q]]) for q, v in enumerate(vector)]
        return vector

    def _arcs(self, symbol: str, q: int) -> list[tuple[str, int, int]]:
        """(letter, cost, next state) of the edits of one row, letters ascending."""
        kind, fault = divmod(SYMBOLS.index(symbol), 4)
        arcs = [("D", self.costs.delete, q)]
        if fault < 2:
            extra, initial = self.costs.truncated * fault, INITIALS[kind]
            keeps = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial)
            if keeps == NEXT[q] or (keeps == SYSTEM and q == START):
                arcs.append(("K", extra, keeps))
            arcs.append(("R", self.costs.rerole + extra, NEXT[q]))
        return arcs

    def step(self, state: int, symbol: str) -> tuple[int, int]:
        """(state, cost) before a row, from the state after it."""
        found = self._step.get((state, symbol))
        if found is None:
            after = self.vectors[state]
            before = [min(cost + after[to] for _, cost, to in self._arcs(symbol, q)) for q in range(4)]
            found = self._step[state, symbol] = self._state(self._closed(before))
        return found

    def edits(self, after: int, symbol: str, q: int) -> tuple[str, int]:
        """The letters of the tight arcs from automaton state ``q`` before a row up to that row, least letter first."""
        key = (after, symbol, q)
        if key not in self._edits:
            before, cost = self.step(after, symbol)
            now, then, letters = self.vectors[before], self.vectors[after], ""
            while True:
                tight = [(a, to) for a, c, to in self._arcs(symbol, q) if c + then[to] == now[q] + cost]
                if self.costs.insert + now[NEXT[q]] == now[q]:
                    tight.append(("I", NEXT[q]))
                letter, to = min(tight)
                letters, q = letters + letter, to
                if letter != "I":
                    break
            self._edits[key] = (letters, q)
        return self._edits[key]

    def repair(self, symbols: str) -> tuple[int, str]:
        """(cost, audit): the least cost, and of the edits of that cost the letters that come first in ASCII."""
        state, cost, states = self.end, self.end_cost, []
        for symbol in reversed(symbols):
            states.append(state)
            state, more = self.step(state, symbol)
            cost += more
        cost += self.vectors[state][START]
        q, audit = START, []
        for symbol in symbols:
            letters, q = self.edits(states.pop(), symbol, q)
            audit.append(letters)
        while q not in (START, ASSISTANT):
            audit.append("I")
            q = NEXT[q]
        return cost, "".join(audit)


@functools.lru_cache(maxsize=8)
def _automaton(costs: Costs) -> Determinised:
    return Determinised(costs)


def _counts(symbols: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and adjacent rows whose initials are not legal."""
    codes = [SYMBOLS.index(x) for x in SYMBOLS]
    of = {f: sum(symbols.count(SYMBOLS[c]) for c in codes if c % 4 == f) for f in (1, 2, 3)}
    initials = symbols.translate({ord(SYMBOLS[c]): INITIALS[c // 4] for c in codes})
    legal = initials.count("su") + initials.count("ua") + initials.count("au")
    return of[2], of[3], of[1], max(len(symbols) - 1, 0) - legal


def _diagnose(costs: Costs):
    """A map over (conversation, symbols): adds counts, cost and audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(costs)
        seen = functools.lru_cache(maxsize=4096)(lambda s: (*_counts(s), *automaton.repair(s)))
        names = ("blank", "duplicate", "truncated", "illegal", "cost", "audit")
        for batch in batches:
            found = [seen(s) if len(s) < 256 else (*_counts(s), *automaton.repair(s)) for s in batch.column("symbols").to_pylist()]
            columns = [pa.array([x[i] for x in found], pa.string() if n == "audit" else pa.int64()) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *columns], names=["conv", *names])

    return run


_WHITE = r"[^\x20\x09-\x0D]"
_ORDER = ("conv", "turn", "role", "head", "sha")


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, damage) -> DataFrame:
    """Rows with the columns that order them, and as damaged: conv, turn, role, head, sha, said_role, said, copies."""
    space = F.lit(" ")
    named = rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), space).alias("role"), F.coalesce(F.col(f"`{text_col}`"), space).alias("text"),
    )
    said_role, said, copies = damage(F.col("conv"), F.col("turn"), F.col("role"), F.col("text")) if damage else (F.col("role"), F.col("text"), F.lit(1))
    return named.select("conv", "turn", "role", F.substring("text", 1, HEAD).alias("head"), F.sha2("text", 256).alias("sha"), said_role.alias("said_role"), said.alias("said"), copies.cast("int").alias("copies"))


def _symbols(turns: DataFrame) -> DataFrame:
    """(conv, symbols): the letters of each conversation's rows in order; every conversation, also one without rows left."""
    spark = turns.sparkSession
    said, role = F.col("said"), F.col("said_role")
    initial = F.instr(F.lit(INITIALS[:3]), F.substring(role, 1, 1))  # 1 to 3; 0 where it is none of them
    kind = F.when((initial == 0) | (role == ""), 3).otherwise(initial - 1)
    fault = F.when(~said.rlike(_WHITE), 2).when(~said.rlike(r"[.!?][\x20\x09-\x0D]*\z"), 1).otherwise(0)
    # A conversation's id is part of the digest, so that equal rows of different conversations are no duplicates.
    digest = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit("null ")), F.length(role), role, said), 256)
    keyed = turns.select(*_ORDER, "copies", F.unhex(digest).alias("digest"), kind.alias("kind"), fault.alias("fault"))
    keyed = keyed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("copies"), F.lit(1)))))
    # Equal rows of a repeated table are dealt over partitions by the place at which they were read.
    keyed = keyed.withColumn("read", F.monotonically_increasing_id())
    placed = keyed.repartitionByRange(shuffle_partitions(spark), *_ORDER, "read").sortWithinPartitions(*_ORDER, "read")
    placed = stash(placed.select("conv", (F.col("copies") > 0).alias("live"), "digest", "kind", "fault", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos")), "turns")
    repeated = placed.filter("live").groupBy("digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    fault = F.when(F.col("fault") == 2, 2).when(F.col("pos") > F.col("first"), 3).otherwise(F.col("fault"))
    letter = F.substring(F.lit(SYMBOLS), F.col("kind") * 4 + fault + 1, F.lit(1))
    marked = placed.join(repeated, "digest", "left").select("conv", "part", F.when(F.col("live"), F.struct("pos", letter.alias("letter"))).alias("row"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda r: r.letter), "")
    parts = marked.groupBy("conv", "part").agg(joined.alias("letters"))  # at most a range partition's rows
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "letters"))), lambda r: r.letters), "")
    return parts.groupBy("conv").agg(whole.alias("symbols"))


class _Conversation:
    """One conversation on its way past: its audit is known, its rows come in order."""

    def __init__(self, head: dict):
        self.head, self.at, self.state, self.step = head, 0, START, 0
        self.least = self.most = self.last = None
        self.turns = 0
        self.hash = hashlib.sha256()

    def _emit(self, edit: str, role: str | None, text: str) -> tuple:
        said = (self.head["conv"], self.step, edit, role, text)
        if role is not None:
            self.hash.update(f"{chr(10) if self.step else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.step += 1
        return said

    def inserted(self) -> Iterator[tuple]:
        audit = self.head["audit"]
        while audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = NEXT[self.state]
            yield self._emit("I", ROLES[self.state], "")

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple]:
        if turn is not None and (self.turns == 0 or turn != self.last):
            self.least = turn if self.turns == 0 else self.least
            self.most = self.last = turn
            self.turns += 1
        yield from self.inserted()
        letter = self.head["audit"][self.at]
        self.at += 1
        if letter == "D":
            yield self._emit("D", None, "")
            return
        if letter == "R":
            self.state = NEXT[self.state]
            role = ROLES[self.state]
        else:
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        yield self._emit(letter, role, text)

    def report(self) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        h = self.head
        return (h["conv"], min(gaps, 2**63 - 1), h["blank"], h["duplicate"], h["truncated"], h["illegal"], h["cost"], h["audit"], self.hash.hexdigest())


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROWS = "step long, edit string, role string, text string"
#: Rows of an output batch.
_OUT_ROWS = 1024


def _stream(names: list[str], report: bool):
    """A map over partitions in which a conversation's audit comes before its rows, and these in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, kinds, size = None, [], None, 0

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        def ended() -> Iterator[tuple]:
            if now is not None:
                last = list(now.inserted())
                yield from [now.report()] if report else last

        for batch in batches:
            kinds = kinds or [batch.schema.field("conv").type, *([*[pa.int64()] * 6, pa.string(), pa.string()] if report else [pa.int64(), *[pa.string()] * 3])]
            for row in batch.to_pylist():
                if row["audit"] is not None:
                    more = list(ended())
                    now = _Conversation(row)
                else:
                    more = list(now.row(row["turn"], row["said_role"], row["said"]))
                    more = [] if report else more
                out += more
                size += sum(len(x[-1]) for x in more)
                if len(out) >= _OUT_ROWS or size >= 1 << 20:
                    yield flushed()
                    out, size = [], 0
        out += ended()
        if out:
            yield flushed()

    return run


def _repair(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, costs: Costs, damage, report: bool) -> DataFrame:
    spark = rows.sparkSession
    bounded_batches(spark)
    turns = _turns(rows, conv_col, turn_col, role_col, text_col, damage)
    kind = turns.schema["conv"].dataType.simpleString()
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    heads = _symbols(turns).mapInArrow(_diagnose(costs), f"conv {kind}, " + ", ".join(f"{c} long" for c in counts) + ", audit string")
    none = F.lit(None)
    texts = turns.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    texts = texts.select(*_ORDER, "said_role", "said", *[none.cast("long").alias(c) for c in counts], none.cast("string").alias("audit"))
    empty = {"turn": "long", "role": "string", "head": "string", "sha": "string", "said_role": "string", "said": "string"}
    heads = heads.select("conv", *[none.cast(t).alias(c) for c, t in empty.items()], *counts, "audit")
    dealt = heads.unionByName(texts).repartition(shuffle_partitions(spark), "conv").sortWithinPartitions("conv", F.col("audit").isNull(), *_ORDER[1:])
    dealt = dealt.select("conv", "turn", "said_role", "said", *counts, "audit")
    names = ["conv", *[f.split()[0] for f in (_REPORT if report else _ROWS).split(", ")]]
    out = dealt.mapInArrow(_stream(names, report), f"conv {kind}, {_REPORT if report else _ROWS}")
    return out.withColumnRenamed("conv", conv_col)


def audit(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", costs: Costs = Costs(), damage=None) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the first 64 code points of the text, then by its
    SHA-256. Null roles and texts are one space, so such a text is blank and such a role fits nowhere. A null conversation id
    is an id of its own. A row's first fault counts: blank (no character but white space), duplicate (role and text seen
    earlier in the conversation), truncated (no ``.``, ``!`` or ``?`` at its end). Repeated rows are duplicates; an empty
    table gives no rows; other columns are ignored. ``gaps`` counts the turns missing between the least and the greatest.

    ``damage``, for tests: a function of the columns (conv, turn, role, text) that gives (role, text, copies); a
    conversation all of whose rows get 0 copies stays, with zeros and an empty audit.

    A conversation's audit is one value, and its hash needs its rows in order: they stream through one task, one at a time.
    """
    return _repair(rows, conv_col, turn_col, role_col, text_col, costs, damage, True)


def repair(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", costs: Costs = Costs(), damage=None) -> DataFrame:
    """The repaired conversations row by row: the id, step (from 0), edit (K, R, I or D), role, text.

    Deleted rows are listed with a null role and the step before which they stood. See ``audit`` for order and edge cases.
    """
    return _repair(rows, conv_col, turn_col, role_col, text_col, costs, damage, False)
