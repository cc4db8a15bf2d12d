"""Sets of hashed word shingles, computed with numpy over a text's bytes."""

from __future__ import annotations

import numpy as np

from millrace.llm.common import WHITE

_CHUNK = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[ord(c) for c in WHITE]] = True


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[_SEPARATOR] = 0
    return values


_VALUES = _byte_values()
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, _CHUNK + 1)
        inverse = pow(_BASE, -1, 2**64)
        for name, base in (("up", _BASE), ("down", inverse)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _chunk_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a piece of text begin, and their hashes, A-Z lowered."""
    apart = np.ones(len(data) + 2, bool)
    apart[1:-1] = _SEPARATOR[data]
    edge = np.flatnonzero(apart[1:] != apart[:-1])
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up, out=sums[1:])
    return start, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def placed_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text of less than 2**18 bytes begin, and the hashes that ``word_hashes`` gives."""
    return _chunk_words(np.frombuffer(text, np.uint8))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of all words of the text, which is read in pieces that end between words."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= _CHUNK:
        return _chunk_words(data)[1]
    out, at = [], 0
    while at < len(data):
        end = min(at + _CHUNK, len(data))
        if end < len(data):
            gaps = np.flatnonzero(_SEPARATOR[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                later = np.flatnonzero(_SEPARATOR[data[end:]])
                end = end + int(later[0]) if len(later) else len(data)
        out.append(_chunk_words(data[at:end])[1])
        at = end
    return np.concatenate(out)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; with fewer words than ``width``, of the whole sequence as one."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(width, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        h = mix(h * np.uint64(_BASE) + words[j : len(words) - n + 1 + j])
    return np.unique(h)
