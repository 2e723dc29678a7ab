"""Vectorised words of Arrow text batches, for tasks that run numpy: whole texts in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1 << 21
_MULT = 0x9E3779B97F4A7C15 | 1
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n``."""
    size = max(PIECE_BYTES, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        inverse = pow(_MULT, -1, 1 << 64)
        p = np.full(size + 1, _MULT, np.uint64)
        q = np.full(size + 1, inverse, np.uint64)
        p[0] = q[0] = 1
        if size > PIECE_BYTES:  # for one very long text; not kept
            return np.multiply.accumulate(p), np.multiply.accumulate(q)
        _POWERS[size] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POWERS[size]


def pieces(texts, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive whole texts, about ``limit`` bytes or one text; null: empty."""
    import pyarrow as pa
    texts = texts.cast(pa.large_string()).fill_null("")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offs = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


def words(data: np.ndarray, offs: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, text number)`` of the words: maximal runs of bytes that are not blank, never across texts."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = ~blank[data]
    cut = np.zeros(n + 1, bool)  # a text begins here
    cut[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = ink[1:]
    ends = np.flatnonzero(ink & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every word, from one running polynomial over all bytes; A-Z count as a-z."""
    p, q = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * p[:len(data)], out=run[1:])
    return mix64((run[ends] - run[starts]) * q[starts])


def windows(word: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, first word)`` of all ``size``-word windows inside a text."""
    if len(word) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(word) - size + 1
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = h * np.uint64(_MULT) + word[j:j + n]
    at = np.flatnonzero(text[:n] == text[size - 1:])
    return mix64(h[at] + np.uint64(size)), at
