"""Token ids of texts by a tokenizer file of the ``tokenizers`` library, each distinct word encoded once.

A tokenizer that ends words, drops white space and lower-cases treats words apart from each other. Texts are cut into the
words that its own rules would give, words not met before are encoded by the library, many in one call, and a text's ids are
put together from theirs. The rules are applied here only to words of ASCII and Latin-1 letters, where they are plain; a
word with any other character goes to the library as it is. A file with other rules has all its texts encoded whole.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np

#: Rules under which words may be told apart here; fixed values of the tokenizer file.
_NORMALISE = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")
_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")
_BLANK = re.compile(r"[ \t\n\r]+")
#: Characters of a text that are in work at once, where it has white space to be cut at.
CHUNK = 1 << 18
#: Words remembered by a process, and words encoded in one call.
REMEMBERED, CALL = 1_000_000, 4096
#: Marks a word that the library has to encode by itself; no plain word has it.
_ODD = "\x00"


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(file)
        rules = json.loads(file)
        split = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        suffix = rules["model"].get("end_of_word_suffix")
        self.by_word = bool(
            suffix and (rules.get("normalizer") or {}).get("normalizers") == _NORMALISE and split[0].get("pattern") == {"Regex": _SPLIT}
            and all(x["content"].startswith("<|") and not (x["lstrip"] or x["rstrip"] or x["single_word"]) for x in rules.get("added_tokens", []))
        )
        if self.by_word:
            vocab = self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
            self.ends[[i for word, i in vocab.items() if word.endswith(suffix)]] = True
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w[0] != _ODD]
        for start in range(0, len(plain), CALL):
            part = plain[start : start + CALL]
            (raw,) = self._whole([" ".join(part)])
            stops = (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1) * 4
            if len(stops) == len(part):
                at = 0
                for word, stop in zip(part, stops.tolist(), strict=True):
                    self.known[word] = raw[at:stop]
                    at = stop
            else:
                self.known |= zip(part, self._whole(part), strict=True)
        odd = [w for w in words if w[0] == _ODD]
        self.known |= zip(odd, self._whole([w[1:] for w in odd]), strict=True)

    def _words(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _WORDS.findall(text.lower())
        found = []
        for word in filter(None, _BLANK.split(text)):
            found += _WORDS.findall(word.lower()) if _PLAIN.fullmatch(word) and "<|" not in word else [_ODD + word]
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [x for t in texts for x in self._whole([t])]
        out: list[list[bytes]] = [[] for _ in texts]
        waiting, size = [], 0
        for i, text in enumerate(texts):
            for chunk in _chunks(text):
                waiting.append((i, self._words(chunk)))
                size += len(chunk)
                if size >= CHUNK:
                    self._join(waiting, out)
                    waiting, size = [], 0
        self._join(waiting, out)
        return [b"".join(parts) for parts in out]

    def _join(self, waiting: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        """Put the ids of words together, after the new ones among them have been learnt in one go."""
        met = set().union(*[words for _, words in waiting])
        new = met.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = met
        if new:
            self._learn(list(new))
        known = self.known
        for i, words in waiting:
            out[i].append(b"".join([known[w] for w in words]))


def _chunks(text: str) -> Iterator[str]:
    """The text in pieces that end before white space."""
    at = 0
    while len(text) - at > CHUNK and (blank := _BLANK.search(text, at + CHUNK)):
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:]


_ENCODERS: dict[int, Encoder] = {}


def encoder(file: bytes) -> Encoder:
    """The encoder of this process for a file, with the words that it remembers."""
    key = zlib.crc32(file)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(file)
    return _ENCODERS[key]
