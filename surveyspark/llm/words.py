"""Words of Arrow text columns as 64-bit hashes, computed on whole byte buffers.

A word is a run of bytes outside x20 and x09-x0D, with A-Z lower-cased. Its hash is a
polynomial over its bytes, taken from prefix sums, then mixed; two different words
share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18  # bytes hashed at once: 64-bit sums of them stay a few MB
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK), _P if kind == "up" else _P_INV, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * CHUNK:
            _powers[kind] = have
    return have[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each span; equal content gives equal hashes."""
    n = len(values)
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power("up", n), out=sums[1:])
    part = (sums[end] - sums[start]) * _power("down", n)[start]
    return mix(part + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One Arrow array of text without nulls (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a large_string array."""
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    first, last = (int(rows[0]), int(rows[-1])) if len(column) else (0, 0)
    raw = np.frombuffer(data, dtype=np.uint8)[first:last] if data is not None else np.empty(0, np.uint8)
    return raw, rows - first


def _one_chunk(raw: np.ndarray, rows: np.ndarray, bare: bool) -> tuple[np.ndarray, ...]:
    """Words of a buffer: hashes, starts, ends; `bare` words lose punctuation at both ends."""
    inside = ~SPACE[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = rows[(rows > 0) & (rows < len(raw))]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    for _ in range(4 if bare else 0):
        e = e - (PUNCTUATION[raw[e - 1]] & (e - s > 1))
        s = s + (PUNCTUATION[raw[s]] & (e - s > 1))
    return span_hashes(LOWER[raw], s, e), s, e


def _cuts(raw: np.ndarray, rows: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about `limit`, ending at a row's end or at white space."""
    at, size = 0, len(raw)
    while at < size:
        stop = min(size, at + limit)
        if stop < size:
            k = int(np.searchsorted(rows, stop, side="right")) - 1
            if rows[k] > at:
                stop = int(rows[k])
            else:  # inside one long row
                row_end = int(rows[k + 1])
                blank = np.flatnonzero(SPACE[raw[stop:row_end]])
                stop = stop + int(blank[0]) if len(blank) else row_end
        yield at, stop
        at = stop


def words(column: pa.Array, limit: int = CHUNK, spans: bool = False,
          bare: bool = False) -> tuple[np.ndarray, ...]:
    """Word hashes of all rows and each row's offsets into them (and byte spans)."""
    raw, rows = buffers(strings(column))
    hashes, starts, ends = [], [], []
    for a, b in _cuts(raw, rows, limit):
        inner = rows[(rows > a) & (rows < b)] - a
        h, s, e = _one_chunk(raw[a:b], inner, bare)
        hashes.append(h)
        starts.append(s + a)
        ends.append(e + a)
    if not hashes:
        empty = np.empty(0, dtype=np.int64)
        out = np.empty(0, dtype=np.uint64), np.zeros(len(rows), dtype=np.int64)
        return (*out, empty, empty) if spans else out
    start = np.concatenate(starts)
    offsets = np.searchsorted(start, rows)
    out = np.concatenate(hashes), offsets
    return (*out, start, np.concatenate(ends)) if spans else out


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words of one row; a shorter row is one run, no words none."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < width:
        width = n
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        total *= np.uint64(0xD1342543DE82EF95)
        total += hashes[k:n - width + 1 + k]
    return mix(total + np.uint64(width))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces, which bounds what a task holds at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_column(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Arrow list<long> of consecutive slices of the given sizes."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))
