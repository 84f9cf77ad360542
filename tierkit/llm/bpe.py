"""Byte-level BPE: boundaries by a scan over code point classes, cached merging.

Pre-tokenisation uses no regex.  Code points of a whole chunk become classes
(letter, number, space, ...; what the pattern looks ahead for is folded into
the class).  Each class is a transition function of a small automaton; the
functions are closed under composition, so composing them is a table lookup
and an associative scan over the chunk, block by block, gives the state before
every character.  State and class say where a piece begins.

Pieces are looked up in a bounded per-process cache; the missing ones are
merged together, one merge per piece and step, in array operations.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.pairs import PairTable, merge
from tierkit.llm.words import ranges, utf8
from tierkit.operators._names import q

RANKS = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 250_000
#: Bytes of text, or ids, worked on at once: the arrays take some 100 times that.
CHUNK = 1 << 18
LONG_PIECE = 128

# Classes.  An apostrophe is SHORT or LONG if one or two letters that make a
# contraction follow; white space is INNER if white space or the end follows,
# else LAST (a blank, which joins the next piece) or LAST_OTHER.
LETTER, NUMBER, OTHER, SHORT, LONG, INNER, LAST, LAST_OTHER = range(8)
# States: FREE expects a new piece; GAP is inside white space; BLANK holds a
# blank for the next piece; IN_* inside a run; ONE and TWO letters of a
# contraction are still to come.
FREE, GAP, BLANK, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE, TWO = range(8)
_BEGIN = {
    LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: ONE, LONG: TWO, INNER: GAP, LAST: BLANK, LAST_OTHER: FREE,
}


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece begins, by state and class."""
    step, begins = np.zeros((8, 8), np.uint8), np.ones((8, 8), np.uint8)
    for state in range(8):
        for c in range(8):
            step[state, c] = _BEGIN[c]
    stay = [
        (GAP, INNER, GAP), (IN_LETTERS, LETTER, IN_LETTERS), (IN_NUMBERS, NUMBER, IN_NUMBERS),
        (BLANK, LETTER, IN_LETTERS), (BLANK, NUMBER, IN_NUMBERS), (ONE, LETTER, FREE), (TWO, LETTER, ONE),
    ]
    stay += [(s, c, IN_OTHERS) for s in (BLANK, IN_OTHERS) for c in (OTHER, SHORT, LONG)]
    for state, c, to in stay:
        step[state, c], begins[state, c] = to, 0
    return step, begins


STEP, BEGINS = _automaton()


def _closure() -> tuple[np.ndarray, np.ndarray]:
    """Functions reachable by composition, and their composition table.

    Function ``c`` < 8 is class ``c``; ``8 + c`` is class ``c`` as the first
    character of a document, whatever came before."""
    functions = [tuple(STEP[:, c].tolist()) for c in range(8)]
    functions += [(int(STEP[FREE, c]),) * 8 for c in range(8)]
    number = {}
    for i, f in enumerate(functions):
        number.setdefault(f, i)
    queue = list(range(16))
    while queue:
        f = functions[queue.pop()]
        for g in functions[:16]:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(functions)
                queue.append(len(functions))
                functions.append(h)
    table = [[number[tuple(g[s] for s in f)] for g in functions] for f in functions]
    return np.array(functions, np.uint8), np.array(table, np.uint16)


APPLY, COMPOSE = _closure()


def scan(codes: np.ndarray, width: int = 256) -> np.ndarray:
    """Function of every prefix of ``codes``: an inclusive, associative scan."""
    n, size = len(codes), len(APPLY)
    if n <= width:
        out, f = np.empty(n, np.uint16), None
        for i, c in enumerate(codes.tolist()):
            f = c if f is None else int(COMPOSE[f, c])
            out[i] = f
        return out
    rows = -(-n // width)
    padded = np.zeros(rows * width, np.uint16)
    padded[:n] = codes
    columns = np.ascontiguousarray(padded.reshape(rows, width).T)
    flat = COMPOSE.ravel()
    for j in range(1, width):
        columns[j] = flat[columns[j - 1].astype(np.int32) * size + columns[j]]
    before = scan(columns[-1][:-1], width).astype(np.int32) * size
    columns[:, 1:] = flat[before[None, :] + columns[:, 1:]]
    return columns.T.ravel()[:n]


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Class of every code point, as the tokenizer library knows letters, numbers
    and white space: its matches of one class over all code points are those that
    it encodes, and their bytes, decoded, are the class."""
    points = "".join(map(chr, (i for i in range(0x110000) if not 0xD800 <= i < 0xE000)))
    own_bytes = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (INNER, r"\s")):
        of_class = tiktoken.Encoding(f"class {kind}", pat_str=pattern, mergeable_ranks=own_bytes, special_tokens={})
        found = bytes(of_class.encode_ordinary(points)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return out


def classes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Function number of every code point; ``first`` marks document starts."""
    out = _kinds()[points]
    ends = np.append(first[1:], True)
    space = out == INNER
    followed = np.append(space[1:], True) | ends
    out[space & ~followed] = LAST_OTHER
    out[(points == 0x20) & ~followed] = LAST
    at = np.flatnonzero((points == 0x27) & ~ends)
    one = points[at + 1]
    out[at[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    at, one = at[~ends[at + 1]], one[~ends[at + 1]]
    two = points[at + 2]
    pair = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        pair |= (one == ord(a)) & (two == ord(b))
    out[at[pair]] = LONG
    return out + np.uint8(8) * first


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the code point at which each piece begins."""
    if not len(points):
        return np.empty(0, np.int64)
    codes = classes(points, first)
    after = APPLY[scan(codes), FREE]
    before = np.append(np.uint8(FREE), after[:-1])
    return np.flatnonzero(BEGINS[before, codes & 7] | first)


class _Numbers(dict):
    """Piece to number; a piece not seen before gets the next one."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Vocabulary:
    """A rank file with its pair table and a bounded cache of merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.text = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.text_at = np.cumsum(self.lengths) - self.lengths
        self._forget()

    @cached_property
    def pairs(self) -> PairTable:
        pairs = []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs.append((a, b, rank))
        left, right, rank = np.array(pairs, np.int64).T
        return PairTable(left, right, rank, rank)

    def _forget(self) -> None:
        self.cache = _Numbers()
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.counts, self.at = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int64)

    def _remember(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        total = self.used + len(ids)
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(total, len(self.flat)), np.int32)])
        if len(self.cache) > len(self.at):
            more = max(len(self.cache), len(self.at))
            self.at = np.concatenate([self.at, np.empty(more, np.int64)])
            self.counts = np.concatenate([self.counts, np.empty(more, np.int32)])
        self.flat[self.used : total] = ids
        self.counts[numbers] = counts
        self.at[numbers] = self.used + np.cumsum(counts) - counts
        self.used = total

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces in order, and their number per piece."""
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        return merge(ids, np.array([len(p) for p in pieces], np.int64), self.pairs)

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges of one long piece, by a heap over linked parts."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n, none = len(ids), self.pairs.none
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.rank(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first.tolist()) if r < none]
        heapq.heapify(heap)
        table = self.ranks
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[j] < n:
                prior[after[j]] = i
            for x in (prior[i], i):
                if x >= 0 and after[x] < n:
                    a, b = ids[x], ids[after[x]]
                    r = table.get(self.tokens[a] + self.tokens[b])
                    if r is not None:
                        heapq.heappush(heap, (r, x, a, b))
        return [i for i in ids if i >= 0]

    def lookup(self, pieces: list[bytes]) -> np.ndarray:
        """Cache number of every piece; merges what is missing."""
        if len(self.cache) > CACHE_PIECES:
            self._forget()
        out = np.fromiter(map(self.cache.__getitem__, pieces), np.int64, len(pieces))
        new, self.cache.new = self.cache.new, []
        whole, short = [p for p in new if p in self.ranks], []
        if whole:
            self._remember(self._numbers(whole), np.array([self.ranks[p] for p in whole]), np.ones(len(whole), np.int64))
        for p in new:
            if p not in self.ranks:
                if len(p) <= LONG_PIECE:
                    short.append(p)
                else:
                    ids = self.merge_long(p)
                    self._remember(self._numbers([p]), np.array(ids), np.array([len(ids)]))
        if short:
            self._remember(self._numbers(short), *self.merge(short))
        return out

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.cache.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, byte offset of each in its document, and ids per document."""
        docs = len(offsets) - 1
        text = data[offsets[0] : offsets[-1]].tobytes()
        points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
        wide = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.cumsum(wide) - wide
        relative = offsets - offsets[0]
        first = np.zeros(len(points), bool)
        starts = np.searchsorted(byte_at, relative[:-1])
        first[starts[relative[:-1] < relative[1:]]] = True
        begin = byte_at[boundaries(points, first)]
        ends = np.append(begin[1:], len(text)).tolist()
        pieces = [text[a:b] for a, b in zip(begin.tolist(), ends)]
        number = self.lookup(pieces)
        counts = self.counts[number].astype(np.int64)
        ids = self.flat[_spread(self.at[number], counts)]
        size = self.lengths[ids]
        token_at = np.cumsum(size) - size
        per_doc = np.diff(np.searchsorted(token_at, relative))
        return ids, token_at - np.repeat(relative[:-1], per_doc), per_doc

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in order, and the number of bytes of each."""
        size = self.lengths[ids]
        return self.text[_spread(self.text_at[ids], size)], size


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``start .. start + count - 1`` of every run, in a row."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    ends = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _encoder(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path or public_tokenizers.path(RANKS))
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in ranges(offsets, CHUNK):
                ids, at, counts = words.encode(data, offsets[lo : hi + 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), _lists(ids, counts), _lists(at, counts)],
                    names=["doc_id", "ids", "offsets"],
                )

    return run


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``offsets`` (byte at which each token begins).

    ``path`` is a rank file that every executor can open (default: the
    installed 50k vocabulary).  No special tokens.  Null and empty text give
    empty lists; a row is one document whatever its id (null and repeated ids
    pass through); other columns are ignored.
    """
    rows = docs.select(q(id_col).cast("long").alias("doc_id"), q(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_encoder(path), "doc_id long, ids array<int>, offsets array<int>")


def _decoder(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path or public_tokenizers.path(RANKS))
        for batch in batches:
            column = batch.column(1)
            ids = column.flatten().to_numpy(zero_copy_only=False)
            counts = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
            ends = np.append(0, np.cumsum(counts))
            for lo, hi in ranges(ends, CHUNK):
                text, size = words.decode(ids[ends[lo] : ends[hi]])
                total = np.append(0, np.cumsum(size))[ends[lo : hi + 1] - ends[lo]].astype(np.int32)
                buffers = [None, pa.py_buffer(total), pa.py_buffer(np.ascontiguousarray(text))]
                out = pa.Array.from_buffers(pa.binary(), hi - lo, buffers)
                rows = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*rows, out], names=["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and the ``decoded`` bytes of rows with those ids."""
    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(
        _decoder(path), "doc_id long, ids array<int>, decoded binary"
    )
