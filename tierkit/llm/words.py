"""Vectorised words of UTF-8 text columns, for use inside Arrow tasks.

A word is a maximal run of bytes other than space and ``\\t\\n\\v\\f\\r``; A-Z
are folded to a-z unless the caller asks for exact words.  Words become 64-bit hashes computed over whole chunks of
documents at once (a quarter of a megabyte of text), so the per-document Python cost
does not depend on the document's length.  Memory is bounded by the chunk, or
by eight bytes per word for a document longer than a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A word array of eight bytes a byte of text is 2 MB, so a task's arrays stay near
#: the caches and a reused worker keeps little freed memory.
CHUNK_BYTES = 1 << 18
_U = np.uint64
_M64 = (1 << 64) - 1


def splitmix(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values of a seed (SplitMix64)."""
    out, state = [], seed & _M64
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & _M64
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & _M64
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & _M64
        out.append(z ^ (z >> 31))
    return np.array(out, dtype=_U)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_EXACT = splitmix(1, 256)
_EXACT[_SPACE] = 0
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class Chunk(NamedTuple):
    """Words of the documents ``first .. first + len(bounds) - 2`` of a batch."""

    first: int
    bounds: np.ndarray  # word index at which each document starts, plus the end
    hashes: np.ndarray  # uint64 per word
    starts: np.ndarray  # byte position of each word in the batch's text buffer


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data, offsets.astype(np.int64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=_U)
    out[0] = 1
    return np.multiply.accumulate(out)


def _words(data: np.ndarray, doc_starts: np.ndarray, values: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, hash) of every word; a word never crosses a document start."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, _U)
    space = between[data]
    first = ~space
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    before[doc_starts[doc_starts < len(data)]] = True
    first &= before
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty(0, _U)
    lens = np.diff(starts, append=len(data))
    begin = starts[0]
    at = np.arange(begin, len(data)) - np.repeat(starts, lens)
    value = values[data[begin:]] * _powers(int(lens.max()))[at]
    return starts, mix(np.add.reduceat(value, starts - begin))


def _long(data: np.ndarray, values: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Words of one long document, in blocks cut between words."""
    at, starts, hashes = 0, [], []
    none = np.zeros(1, np.int64)
    while at < len(data):
        end = at + CHUNK_BYTES
        while end < len(data):
            gaps = np.flatnonzero(between[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end += CHUNK_BYTES
        s, h = _words(data[at : min(end, len(data))], none, values, between)
        starts.append(s + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def ranges(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents whose text is at most ``limit`` bytes, or one document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def byte_values(between: np.ndarray) -> np.ndarray:
    """Values of the bytes of words for other bytes ``between`` words, A-Z as a-z."""
    values = np.where(between, _U(0), splitmix(1, 256))
    values[65:91] = values[97:123]
    return values


def chunks(column: pa.Array, fold: bool = True, between: np.ndarray | None = None) -> Iterator[Chunk]:
    """The words of a whole string column, chunk by chunk; ``fold`` A-Z to a-z.
    ``between`` marks the bytes that are not of words, if not white space."""
    data, offsets = utf8(column)
    values = (_FOLDED if fold else _EXACT) if between is None else byte_values(between)
    between = _SPACE if between is None else between
    for lo, hi in ranges(offsets):
        a, b = int(offsets[lo]), int(offsets[hi])
        rel = offsets[lo : hi + 1] - a
        starts, hashes = _long(data[a:b], values, between) if b - a > CHUNK_BYTES else _words(data[a:b], rel[:-1], values, between)
        yield Chunk(lo, np.searchsorted(starts, rel), hashes, starts + a)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that start at each word (``len - k + 1`` of them)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    acc = hashes[:n].copy()
    for i in range(1, k):
        acc *= _STEP
        acc += hashes[i : n + i]
    return mix(acc)


def shingles(doc: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct ``k``-word shingles of one document's word hashes; a
    shorter document's whole sequence counts as one, no word gives none."""
    if not len(doc):
        return np.empty(0, _U)
    return np.unique(windows(doc, min(k, len(doc))))
