"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces, with byte fallback.

A text gets a blank in front and every blank becomes the marker; no piece of the vocabulary holds the marker
after another character, so the best path falls apart at the start of each run of markers. Each distinct word (a
run of markers and what follows) that a process does not remember is segmented, many side by side in numpy; a text is
then the concatenation of its words' pieces. Decoding joins pieces, reads byte pieces as UTF-8 and turns markers
back into blanks. The vocabulary comes from a model file and is never trained here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_fields, bounded_batches

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
NORMAL, UNKNOWN, BYTE = 1, 2, 6
#: A word longer than this is segmented by itself, so that one long word does not widen the whole batch.
LONG_WORD = 64
#: Words segmented side by side, and distinct words of a generation that a process remembers. Results do not depend on either.
SIDE_BY_SIDE, KEEP_WORDS = 8192, 300_000
LOW = -1e30


@dataclass(frozen=True)
class Trie:
    """Double-array trie over UTF-8 bytes: child of s by byte b is base[s] + b + 1 where check says s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, keys: list[bytes], values: list[int]) -> Trie:
        children: list[dict[int, int]] = [{}]
        ends = {}
        for key, value in zip(keys, values, strict=True):
            node = 0
            for b in key:
                node = children[node].setdefault(b, len(children))
                if node == len(children):
                    children.append({})
            ends[node] = value
        # Only children fill any hole; several go to the first fit in a window that moves on as it fills up.
        used, base, check, value = bytearray(b"\1"), {}, {}, {}
        place, todo, hole, window = {0: 0}, [0], 1, 1
        while todo:
            node = todo.pop()
            at, kids = place[node], children[node]
            if node in ends:
                value[at] = ends[node]
            if not kids:
                continue
            codes = [b + 1 for b in kids]
            if window + 1024 > len(used) or hole + 1024 > len(used):
                used += bytes(len(used) + 2048)
            if len(codes) == 1:
                while used[hole] or hole <= codes[0]:
                    hole += 1
                start = hole - codes[0]
            else:
                start = next((s for s in range(window, window + 128) if not any(used[s + c] for c in codes)), None)
                if start is None:
                    window += 64
                    todo.append(node)
                    continue
            base[at] = start
            for (b, child), code in zip(kids.items(), codes, strict=True):
                used[start + code], check[start + code], place[child] = 1, at, start + b + 1
                todo.append(child)
        size = len(used) + 260  # a step from any state stays inside the arrays

        def array(found: dict[int, int], rest: int) -> np.ndarray:
            out = np.full(size, rest, np.int32)
            out[list(found)] = list(found.values())
            return out

        return cls(array(base, 0), array(check, -1), array(value, -1))


class Words:
    """Ids of words met before, as bytes, in two generations: a full one becomes the older, whose words go unless met again."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def missing(self, words: set[str]) -> set[str]:
        """Those of the words that are not remembered; the others are in the young generation from now on."""
        if len(self.young) > KEEP_WORDS:
            self.older, self.young = self.young, {}
        absent = words.difference(self.young)
        again = absent.intersection(self.older)
        self.young.update({w: self.older[w] for w in again})
        return absent - again


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    trie: Trie
    byte_ids: np.ndarray
    unknown: int
    #: Score of a character that no piece covers; it is written as its bytes.
    unknown_score: float
    splits: bool
    #: What each piece stands for in the decoded bytes.
    written: list[bytes]
    store: Words = field(default_factory=Words)


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of the fields of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        shift = value = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = (varint(at)) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def load(data: bytes, scores: str = "auto") -> Vocabulary:
    """The vocabulary of a model file.

    Pieces, scores and kinds are read. The file's normaliser is not applied (texts are taken as they are, apart from
    blanks), and user-defined and control pieces are never chosen.

    scores: "model" takes the file's scores; "rank" takes log probabilities by Zipf's law from the order of the
    pieces, -log(rank + 1); "auto" is "model" for a unigram model and "rank" for others, whose scores are merge
    orders and no log probabilities.
    """
    pieces, given, kinds, unigram = [], [], [], False
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = float(np.frombuffer(v, "<f4")[0])
                elif n == 3:
                    kind = v
            pieces.append(piece)
            given.append(score)
            kinds.append(kind)
        elif number == 2:
            unigram = dict(_fields(value)).get(3, 1) == 1
    kind = np.array(kinds)
    normal = np.flatnonzero(kind == NORMAL)
    if scores == "model" or (scores == "auto" and unigram):
        score = np.array(given, np.float64)
    else:
        score = np.zeros(len(pieces))
        score[normal] = -np.log(np.arange(len(normal)) + 2.0)
    byte_ids = np.full(256, -1)
    for i in np.flatnonzero(kind == BYTE):
        byte_ids[int(_BYTE.fullmatch(pieces[i])[1], 16)] = i
    unknown = int(np.flatnonzero(kind == UNKNOWN)[0]) if (kind == UNKNOWN).any() else 0
    splits = not any(MARK in pieces[i].lstrip(MARK) for i in normal)
    trie = Trie.build([pieces[i].encode() for i in normal], normal.tolist())
    as_bytes = {NORMAL: lambda p: p.encode(), BYTE: lambda p: bytes([int(_BYTE.fullmatch(p)[1], 16)]), UNKNOWN: lambda _: " ⁇ ".encode()}
    written = [as_bytes[k](p) if k in as_bytes else b"" for p, k in zip(pieces, kinds, strict=True)]
    return Vocabulary(pieces, score, kind, trie, byte_ids, unknown, float(score[normal].min()) - 10.0, splits, written)


def viterbi(words: list[str], v: Vocabulary) -> list[np.ndarray]:
    """The best segmentation of each word; of equal scores the path with the longer last piece.

    All words advance together: ``best`` and ``back`` have a row per word and a column per byte.
    """
    raw = [w.encode() for w in words]
    length = np.array([len(x) for x in raw])
    width = int(length.max(initial=0))
    data = np.zeros((len(raw), width), np.int32)
    data[np.arange(width)[None, :] < length[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
    best = np.full((len(raw), width + 1), LOW)
    best[:, 0] = 0
    back, piece = np.zeros((len(raw), width + 1), np.int32), np.full((len(raw), width + 1), -1, np.int32)
    base, check, value = v.trie.base, v.trie.check, v.trie.value
    for start in range(width):
        rows = np.flatnonzero(best[:, start] > LOW)
        here = best[rows, start]
        inside = length[rows] > start
        rows, here = rows[inside], here[inside]
        # a character without a piece of its own may be taken as unknown
        lead = data[rows, start]
        size = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        alone = np.zeros(len(rows), bool)
        live, state, of = np.arange(len(rows)), np.zeros(len(rows), np.int64), rows
        at = start
        while len(live):
            step = base[state] + data[of, at] + 1
            ok = (check[step] == state) & (base[state] > 0)
            live, state = live[ok], step[ok]
            of = rows[live]
            at += 1
            ids = value[state]
            hit = ids >= 0
            if hit.any():
                r, i = of[hit], ids[hit]
                alone[live[hit]] |= size[live[hit]] == at - start
                score = here[live[hit]] + v.scores[i]
                better = score > best[r, at]
                r = r[better]
                best[r, at], back[r, at], piece[r, at] = score[better], start, i[better]
            more = length[of] > at
            live, state, of = live[more], state[more], of[more]
        for n in np.unique(size[~alone]):
            r = rows[~alone & (size == n)]
            score = best[r, start] + v.unknown_score
            better = score > best[r, start + n]
            r = r[better]
            best[r, start + n], back[r, start + n], piece[r, start + n] = score[better], start, -1
    # All words are walked back together; what a step took is kept as (word, piece or -1, start, end).
    rows, at, steps = np.arange(len(raw)), length, []
    while len(rows := rows[(alive := at > 0)]):
        at = at[alive]
        steps.append((rows, piece[rows, at], back[rows, at], at))
        at = steps[-1][2]
    of, ids, start, end = (np.concatenate([s[i] for s in steps[::-1]]) if steps else np.zeros(0, np.int64) for i in range(4))
    order = np.argsort(of, kind="stable")
    of, ids, start, end = of[order], ids[order], start[order], end[order]
    flat, stops = ids.astype(np.int32), np.cumsum(np.bincount(of, minlength=len(raw))).tolist()
    parts = [flat[a:b] for a, b in zip([0, *stops], stops, strict=False)]
    for k in np.unique(of[ids < 0]).tolist():
        own = range(stops[k - 1] if k else 0, stops[k])
        parts[k] = np.array([i for p in own for i in ([flat[p]] if flat[p] >= 0 else _fallback(raw[k][start[p] : end[p]], v)[::-1])], np.int32)
    return parts


def _fallback(char: bytes, v: Vocabulary) -> list[int]:
    """The bytes of a character, last first; the unknown piece in a vocabulary without bytes."""
    ids = [int(v.byte_ids[b]) for b in reversed(char)]
    return ids if min(ids) >= 0 else [v.unknown]


def encode_batch(texts: list[str], v: Vocabulary) -> list[np.ndarray]:
    """Piece ids of each text; an empty text has none."""
    split = []
    for text in texts:
        marked = (MARK + text.replace(" ", MARK)) if text else ""
        split.append(_WORD.findall(marked) if v.splits else [marked] if text else [])
    new = v.store.missing(set().union(*split))
    own = {w: viterbi_long(w, v).tobytes() for w in new if len(w) > LONG_WORD}
    short = sorted(new.difference(own), key=len)
    known = v.store.young
    for i in range(0, len(short), SIDE_BY_SIDE):
        part = short[i : i + SIDE_BY_SIDE]
        known.update(zip(part, [x.tobytes() for x in viterbi(part, v)], strict=True))
    return [np.frombuffer(b"".join([own[w] if w in own else known[w] for w in words]), np.int32) for words in split]


def viterbi_long(word: str, v: Vocabulary) -> np.ndarray:
    """The same for one word of any length, one byte after the other."""
    text = word.encode()
    base, check, value, scores = v.trie.base, v.trie.check, v.trie.value, v.scores
    best, back, piece = [LOW] * (len(text) + 1), [0] * (len(text) + 1), [-1] * (len(text) + 1)
    best[0] = 0.0
    for start in range(len(text)):
        here, lead = best[start], text[start]
        if here <= LOW:
            continue
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        state, at, alone = 0, start, False
        while at < len(text):
            step = int(base[state]) + text[at] + 1
            if not base[state] or check[step] != state:
                break
            state, at = step, at + 1
            if (i := int(value[state])) >= 0:
                alone |= at - start == size
                if (score := here + float(scores[i])) > best[at]:
                    best[at], back[at], piece[at] = score, start, i
        if not alone and (score := here + v.unknown_score) > best[start + size]:
            best[start + size], back[start + size], piece[start + size] = score, start, -1
    at, ids = len(text), []
    while at:
        ids += [piece[at]] if piece[at] >= 0 else _fallback(text[back[at] : at], v)
        at = back[at]
    return np.array(ids[::-1], np.int32)


def decode(ids: list[int] | np.ndarray, v: Vocabulary) -> str:
    """The text of the ids: bytes that are no UTF-8 become U+FFFD, markers blanks; the blank in front goes."""
    text = b"".join(map(v.written.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: bytes, *, text_col: str = "text", scores: str = "auto", keep_text: bool = True) -> DataFrame:
    """docs plus ids (array<int>), n_pieces, n_bytes and lossless (columns of those names are replaced).

    Without ``keep_text`` the text column goes, and does not travel back from the Python workers.

    n_bytes counts byte-fallback pieces; lossless says whether decoding the ids gives the text back (a marker in
    the text itself becomes a blank). Null and empty texts have no pieces. The vocabulary is read on the driver and
    broadcast (a few MB; its size is that of the file, whatever the documents). Every row's whole text is encoded in
    one map without a shuffle; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(model, scores))
    new = ("ids", "n_pieces", "n_bytes", "lossless")
    kept = [c for c in docs.columns if c not in new]
    at = kept.index(text_col)
    told = [i for i, c in enumerate(kept) if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            found = encode_batch(texts, v)
            lossless = [decode(x.tolist(), v) == text for x, text in zip(found, texts, strict=True)]
            sizes = np.array([len(x) for x in found], np.int64)
            flat = np.concatenate([*found, np.zeros(0, np.int32)])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            is_byte = np.concatenate([[0], np.cumsum(v.kinds[flat] == BYTE)])
            more = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())), pa.array(sizes, pa.int64())]
            more += [pa.array(is_byte[offsets[1:]] - is_byte[offsets[:-1]], pa.int64()), pa.array(lossless, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in told), *more], names=[*(kept[i] for i in told), *new])

    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    fields = arrow_fields(rows.select(*[F.col(f"`{kept[i]}`") for i in told]))
    return rows.mapInArrow(run, ", ".join([*([fields] if fields else []), "ids array<int>", "n_pieces long", "n_bytes long", "lossless boolean"]))


def decode_ids(rows: DataFrame, model: bytes, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """rows plus the decoded text of an id array; null ids give null, no ids the empty text."""
    bounded_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(load(model))
    kept = [c for c in rows.columns if c != out_col]
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            texts = [None if x is None else decode(x, v) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out_col])

    rows = rows.select(*[F.col(f"`{c}`") for c in kept])
    return rows.mapInArrow(run, f"{arrow_fields(rows)}, `{out_col}` string")
