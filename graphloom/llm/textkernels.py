"""Numpy kernels over flat UTF-8 buffers, shared by the text operators.

An Arrow string column already is one flat byte buffer with offsets, so words,
word hashes and shingle hashes of a whole batch come from a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass works on; bounds the temporaries of a task.
PASS_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_CODE[ord("A") : ord("Z") + 1] = _BYTE_CODE[ord("a") : ord("z") + 1]

_powers = np.ones(1, dtype=np.uint64)
_inverse_powers = np.ones(1, dtype=np.uint64)


def _grow_powers(n: int) -> None:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverse_powers", _BASE_INV)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            globals()[name] = np.multiply.accumulate(table)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (new array)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_slices(column: pa.Array, pass_bytes: int = PASS_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets from 0) in slices of about pass_bytes and at most so many rows; null counts as empty.

    A slice holds at least one row, and always whole rows.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offs, offs[first] + pass_bytes, side="right")) - 1)
        end = min(end, n, first + rows)
        yield first, end, raw[offs[first] : offs[end]], offs[first : end + 1] - offs[first]
        first = end


def byte_runs(buf: np.ndarray, apart: np.ndarray = _WHITE, pass_bytes: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Start and end of runs of about pass_bytes that end after a byte of `apart`, so that no word is cut; a longer word makes a longer run."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + pass_bytes)
        if end < n:
            found = np.flatnonzero(apart[buf[at:end]])
            while not len(found) and end < n:
                begun, end = end, min(n, end + pass_bytes)
                found = np.flatnonzero(apart[buf[begun:end]]) + (begun - at)
            end = at + int(found[-1]) + 1 if len(found) else n
        yield at, end
        at = end


def word_spans(buf: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (what `apart` doesn't hold; by default [^\\x20\\x09-\\x0D]+), and for each row the index of its first word (one more at the end)."""
    n = len(buf)
    if n == 0:
        zero = np.zeros(0, dtype=np.int64)
        return zero, zero, np.zeros(len(offsets), dtype=np.int64)
    white = apart[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = white[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = white[1:]
    starts = np.flatnonzero(~white & (before | edge[:-1]))
    ends = np.flatnonzero(~white & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes (A-Z as a-z) have equal hashes wherever they stand."""
    _grow_powers(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[buf] * _powers[: len(buf)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * _inverse_powers[starts])


def shingle_hashes(buf: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of word shingles of each row, and where each row's begin (one more at the end).

    A row of fewer than width words, but at least one, has one shingle: all its
    words. A row without a word has none. Words are compared with A-Z lowered.
    """
    starts, ends, first = word_spans(buf, offsets)
    words = span_hashes(buf, starts, ends)
    counts = np.diff(first)
    odd = np.array([pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j in range(width)], dtype=np.uint64)
    n_shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    bounds = np.zeros(len(first), dtype=np.int64)
    np.cumsum(n_shingles, out=bounds[1:])
    out = np.zeros(int(bounds[-1]), dtype=np.uint64)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for j in range(width):
            rolled += words[j : len(words) - width + 1 + j] * odd[j]
        row = np.repeat(np.arange(len(counts)), counts)
        inside = row[: len(rolled)] == row[width - 1 :]
        out[np.repeat(counts >= width, n_shingles)] = rolled[inside]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        out[bounds[i]] = (words[first[i] : first[i + 1]] * odd[: counts[i]]).sum() + np.uint64(counts[i])
    return mix64(out), bounds
