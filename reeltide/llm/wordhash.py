"""Hashes of the words and word shingles of Arrow string columns, without a Python object per word.

A word is a run of bytes other than space and 0x09-0x0D; A-Z may be folded first. A word's hash is a
polynomial over its bytes modulo 2**64, finished by a bit mixer; equal words have equal hashes and
different ones collide with odds of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Bytes of text worked on at once (a longer document is a chunk of its own).
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        p[0] = 1
        np.cumprod(p, out=p)
        if n > CHUNK_BYTES + 1:  # a giant document's table isn't kept
            return p
        have = _powers[base] = p
    return have[:n]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``size`` bytes each, at least one row."""
    ends = _offsets(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield at, min(to, len(column))
        at = to


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]


def as_strings(column: pa.Array) -> pa.Array:
    """Nulls become empty, as wordless as they are."""
    return (column.cast(pa.string()) if not pa.types.is_string(column.type) else column).fill_null("")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the column and where each row begins (one more at the end)."""
    ends = _offsets(column).astype(np.int64)
    if not len(column) or ends[0] == ends[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and its row."""
    ink = ~_SPACE[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    cut = rows[(rows > 0) & (rows < len(data))]
    first[cut] = ink[cut]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    last[cut - 1] = ink[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(rows, start, "right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * _power(_BASE_INVERSE, len(data) + 1)[start])


def word_hashes(column: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of the column, in order."""
    data, rows = text_bytes(column)
    if fold:
        data = _FOLD[data]
    start, end, row = word_spans(data, rows)
    return span_hashes(data, start, end), row


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct k-word shingles of each row, ordered by row, then hash.

    A row of one to k-1 words has its whole word sequence as its only shingle; one without words has none.
    """
    word, row = word_hashes(column)
    n = np.bincount(row, minlength=len(column))
    begin = np.cumsum(n) - n
    weight = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    if len(word) >= k:
        h = sum((word[j : len(word) - k + 1 + j] * weight[j] for j in range(k)), np.zeros(len(word) - k + 1, np.uint64))
        whole = row[: len(word) - k + 1] == row[k - 1 :]
        h, at = h[whole], row[: len(word) - k + 1][whole]
    else:
        h, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        tail = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = n[short] > j
            tail[has] += word[begin[short[has]] + j] * weight[j]
        h, at = np.concatenate([h, tail + n[short].astype(np.uint64)]), np.concatenate([at, short])
    h = mix(h)
    order = np.lexsort((h, at))
    h, at = h[order], at[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (at[1:] != at[:-1])
    return h[keep], at[keep]


def sequence_hashes(items: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of ``items`` (64-bit hashes themselves)."""
    total = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(items * _power(_BASE, len(items)), out=total[1:])
    return mix((total[end] - total[start]) * _power(_BASE_INVERSE, len(items) + 1)[start] + (end - start).astype(np.uint64))
