"""Token ids of a byte-level BPE vocabulary for whole columns of text.

Byte-level BPE merges inside pre-tokens only, and a corpus repeats its pre-tokens, so
each distinct one is encoded once in a worker (by the tokenizers library) and looked up
afterwards. Pre-tokens are found on arrays of code points. Texts with a character class
this module does not decide by itself, or with an apostrophe contraction, are encoded
whole by the library.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from surveyspark.llm import words as W

KNOWN = 0x250           # code points below have a fixed class here
KEEP = 1 << 19          # pre-tokens a worker remembers before it starts anew
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_CLASS = np.array([
    _SPACE if c in (9, 10, 11, 12, 13, 32, 0x85, 0xA0) else
    _LETTER if unicodedata.category(chr(c))[0] == "L" else
    _NUMBER if unicodedata.category(chr(c))[0] == "N" else _OTHER
    for c in range(KNOWN)], dtype=np.uint8)
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """One for each vocabulary file and worker."""

    def __new__(cls, path: str):
        if path not in _encoders:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
            from tokenizers import Tokenizer

            new = super().__new__(cls)
            new.tokenizer = Tokenizer.from_file(path)
            new.tokenizer.encode_special_tokens = True  # their strings are ordinary text
            new._forget()
            _encoders[path] = new
        return _encoders[path]

    def _forget(self) -> None:
        self.known = np.empty(0, dtype=np.uint64)   # sorted hashes of the pre-tokens ...
        self.place = np.empty(0, dtype=np.int64)    # ... and where each one's ids are
        self.ids = np.empty(0, dtype=np.uint32)
        self.begin = np.zeros(1, dtype=np.int64)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of every text of a large_string array."""
        texts = column.to_pylist()
        out: list = [None] * len(texts)
        plain, hard = [], []
        codes = []
        for i, t in enumerate(texts):
            x = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
            if len(x) and (x.max() >= KNOWN or _contraction(x)):
                hard.append(i)
            else:
                plain.append(i)
                codes.append(x)
        for i, e in zip(hard, self.tokenizer.encode_batch([texts[i] for i in hard], add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype=np.uint32)
        for i, ids in zip(plain, self._plain(codes, "".join(texts[i] for i in plain))):
            out[i] = ids
        return out

    def _plain(self, codes: list[np.ndarray], text: str) -> list[np.ndarray]:
        sizes = np.array([len(x) for x in codes], dtype=np.int64)
        edges = np.append(0, np.cumsum(sizes))
        flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
        begin = pre_tokens(flat, edges)
        if not len(begin):
            return [np.empty(0, np.uint32) for _ in codes]
        end = np.append(begin[1:], len(flat))
        hashes, first, which = np.unique(
            W.span_hashes(flat, begin, end), return_index=True, return_inverse=True)
        at = self._places(hashes, text, begin[first], end[first])[which]
        length = self.begin[at + 1] - self.begin[at]
        stop = np.cumsum(length)
        source = np.arange(stop[-1]) + np.repeat(self.begin[at] - (stop - length), length)
        ids = self.ids[source]
        borders = np.append(0, stop)[np.searchsorted(begin, edges)]
        return [ids[borders[i]:borders[i + 1]] for i in range(len(codes))]

    def _places(self, hashes: np.ndarray, text: str, begin, end) -> np.ndarray:
        """Where the ids of each pre-token (sorted by hash) are kept; new ones are encoded."""
        if len(self.known) > KEEP:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            texts = [text[a:b] for a, b in zip(begin[new].tolist(), end[new].tolist())]
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            places = np.arange(len(found)) + len(self.begin) - 1
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(sizes))
            self.ids = np.append(self.ids, np.array([y for x in found for y in x], dtype=np.uint32))
            self.known = np.insert(self.known, at[new], hashes[new])
            self.place = np.insert(self.place, at[new], places)
            at = np.searchsorted(self.known, hashes)
        return self.place[at]


def _contraction(x: np.ndarray) -> bool:
    """Whether an apostrophe comes before a letter that can make a contraction."""
    at = np.flatnonzero(x[:-1] == 39)
    return bool(len(at)) and bool(np.isin(x[at + 1], [ord(c) for c in "stmdrvl"]).any())


def pre_tokens(flat: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts laid end to end begin.

    A pre-token is a run of letters, of digits or of other signs, each with one space
    before it if there is one; white space that is left is one pre-token, without its
    last character where text follows.
    """
    n = len(flat)
    if not n:
        return np.empty(0, np.int64)
    kind = _CLASS[flat]
    start = np.ones(n, dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    edge = edges[(edges > 0) & (edges < n)]
    start[edge] = True
    space = kind == _SPACE
    # the last white space before text stands apart from what precedes it ...
    before_text = np.zeros(n, dtype=bool)
    before_text[:-1] = space[:-1] & ~space[1:]
    before_text[edge - 1] = False
    start |= before_text
    # ... and, if it is a space, takes the text that follows it along
    joined = np.flatnonzero(before_text & (flat == 32)) + 1
    start[joined] = False
    return np.flatnonzero(start)
