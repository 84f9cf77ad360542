"""Pack documents into token windows by order-preserving dynamic programming.

Documents stay in the order in which their task reads them.  Window cuts may
fall at document ends (free), sentence ends and, inside a long stretch without
either, at regular tokens (both at a penalty).  With boundaries ``b`` and
``f(j)`` the least cost of the tokens before ``b_j``,

    f(j) = penalty(j) + min over i with b_j - b_i <= W of f(i) + W - (b_j - b_i)

and ``f(i) + b_i`` does not depend on ``j``, so the minimum over the sliding
window comes from a monotone queue in constant time.  Each task packs a stream
of about a million tokens at a time and carries its open last window on, so
only one window per task stays short.  No shuffle; memory is one stretch.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tierkit.llm.pairs import PairTable, merge
from tierkit.llm.words import ranges, utf8
from tierkit.operators._names import q

WINDOW = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
STRETCH = 1 << 20
SENTENCE, ANYWHERE = 8, 64
FILL = 256
CACHE_STRETCHES, CACHE_PIECES = 600_000, 300_000


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if printable Latin-1, else the next code point from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words:
    """Token ids of texts by the tokenizer file, through caches.

    White space never survives the tokenizer's normaliser, so a text's ids are
    those of its stretches between blanks and line ends, in order.  A stretch
    of ASCII and Latin-1 letters splits into the tokenizer's own pieces; those
    not seen before are merged together by the file's merge list.  Any other
    stretch, and one that holds an added token's text, goes to the tokenizer whole.
    """

    _LETTERS = "a-zß-öø-ÿ"
    _SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]*")
    _PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")
    _LONGEST = 128

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, self.suffix = model["vocab"], model["end_of_word_suffix"]
        # The tokenizer finds these in the text as it stands, before it splits it.
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        symbols = _byte_symbols()
        self.inner = np.array([vocabulary[symbols[b]] for b in range(256)])
        self.last = np.array([vocabulary[symbols[b] + self.suffix] for b in range(256)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocabulary[p[i]] for p in pairs], np.int64) for i in (0, 1))
        merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.pairs = PairTable(left, right, np.arange(len(pairs)), merged)
        self.ends = np.zeros(1 + max(*vocabulary.values(), *self.tokenizer.get_added_tokens_decoder()), bool)
        self.ends[[i for t, i in vocabulary.items() if t.removesuffix(self.suffix)[-1:] in (".", "!", "?")]] = True
        self.stretches: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _merge(self, pieces: list[str]) -> None:
        """Learn the ids of pieces not seen before."""
        raw = [p.encode() for p in pieces]
        lens = np.array([len(p) for p in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids, at = self.inner[data], np.cumsum(lens) - 1
        ids[at] = self.last[data[at]]
        merged, counts = merge(ids, lens, self.pairs)
        buffer, ends = merged.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        self.pieces.update(zip(pieces, (buffer[a:b] for a, b in zip([0, *ends], ends))))

    def _learn(self, stretches: set[str], marked: bool) -> None:
        split, new = {}, set()
        for s in stretches:
            if len(s) <= self._LONGEST and s.isascii() and s.isalpha():  # one piece
                split[s] = found = [s.lower()]
                if found[0] not in self.pieces:
                    new.add(found[0])
            elif len(s) <= self._LONGEST and self._SIMPLE.fullmatch(s) and not (marked and any(m in s for m in self.marks)):
                split[s] = found = self._PIECE.findall(s.lower())
                new.update(p for p in found if p not in self.pieces)
            else:
                ids = self.tokenizer.encode(s, add_special_tokens=False).ids
                self.stretches[s] = np.array(ids, "<u4").tobytes()
        if new:
            self._merge(list(new))
        for s, found in split.items():
            self.stretches[s] = b"".join([self.pieces[p] for p in found])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.stretches) > CACHE_STRETCHES:
            self.stretches = {"": b""}
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.stretches
        new = set(chain.from_iterable(split)).difference(known)
        if new:
            self._learn(new, any(m in t for m in self.marks for t in texts))
        return [np.frombuffer(b"".join(map(known.__getitem__, found)), "<u4") for found in split]


@lru_cache(1)
def words(path: str) -> Words:
    return Words(path)


def cuts(bounds: np.ndarray, penalties: np.ndarray, window: int = WINDOW) -> list[int]:
    """Cut positions of least padding and penalty.  ``bounds`` rise from above
    0 in steps of at most ``window``; the last one is the end and always cut."""
    where, cost = [0, *bounds.tolist()], [0, *penalties.tolist()]
    best, prior = [0] * len(where), [0] * len(where)
    queue = deque([(0, 0, 0)])  # rising f(i) + b_i, with i and b_i
    for j in range(1, len(where)):
        b = where[j]
        while b - queue[0][2] > window:
            queue.popleft()
        key, i, _ = queue[0]
        value = key + window - b + cost[j]
        best[j], prior[j] = value, i
        key = value + b
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j, b))
    out, j = [], len(where) - 1
    while j:
        out.append(where[j])
        j = prior[j]
    return out[::-1]


def places(ends: np.ndarray, sentence: np.ndarray, fill: int = FILL) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts and penalties: document ends, sentence ends, and every
    ``fill`` tokens of a stretch that has neither."""
    bounds = np.union1d(ends, sentence)
    gaps = np.diff(bounds, prepend=0)
    more = [np.arange(b - g + fill, b, fill) for b, g in zip(bounds[gaps > fill].tolist(), gaps[gaps > fill].tolist())]
    penalties = np.where(np.isin(bounds, ends), 0, SENTENCE)
    if more:
        extra = np.concatenate(more)
        bounds, penalties = np.append(bounds, extra), np.append(penalties, np.full(len(extra), ANYWHERE))
        order = np.argsort(bounds)
        bounds, penalties = bounds[order], penalties[order]
    return bounds, penalties


class _Stream:
    """Documents not yet in a closed window, in order."""

    def __init__(self, window: int, sequence: int, ends: np.ndarray):
        self.window, self.sequence, self.sentence_end = window, sequence, ends
        self.docs: list[tuple[int | None, int, np.ndarray, int]] = []  # id, tokens before, ids, tokens in all
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, ids, len(ids)))
        self.tokens += len(ids)

    def close(self, last: bool) -> Iterator[tuple]:
        """Pieces of the closed windows; unless ``last``, the final one stays open."""
        if not self.docs:
            return
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum([len(d[2]) for d in self.docs])
        bounds, penalties = places(ends, np.flatnonzero(self.sentence_end[ids]) + 1, min(FILL, self.window))
        found = cuts(bounds, penalties, self.window)
        keep_from = len(ids) if last else (found[-2] if len(found) > 1 else 0)
        at, d, left = 0, 0, []
        for cut in found if last else found[:-1]:
            offset = 0
            while at < cut:
                doc_id, before, tokens, total = self.docs[d]
                begin = int(ends[d]) - len(tokens)
                stop = min(cut, int(ends[d]))
                yield doc_id, before + at - begin, stop - at, total, self.sequence, offset, tokens[at - begin : stop - begin]
                offset += stop - at
                at = stop
                d += at == ends[d]
            self.sequence += 1
        for i in range(d, len(self.docs)):
            doc_id, before, tokens, total = self.docs[i]
            skip = max(0, keep_from - (int(ends[i]) - len(tokens)))
            left.append((doc_id, before + skip, tokens[skip:], total))
        self.docs, self.tokens = left, sum(len(x[2]) for x in left)


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _table(pieces: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*pieces))
    columns[-1] = [x.astype("<u4").tobytes() for x in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)], names=[n for n, _ in _FIELDS])


def _packer(path: str | None, window: int, end_id: int, stretch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = words(path or public_tokenizers.path(TOKENIZER))
        end = np.array([end_id], "<u4")
        stream = _Stream(window, TaskContext.get().partitionId() << 40, tokens.ends)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo, hi in ranges(utf8(texts)[1]):
                found = tokens.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                for doc_id, doc in zip(ids[lo:hi], found):
                    stream.add(doc_id, np.concatenate([doc, end]))
                if stream.tokens >= stretch:
                    pieces = list(stream.close(last=False))
                    if pieces:
                        yield _table(pieces)
        pieces = list(stream.close(last=True))
        if pieces:
            yield _table(pieces)

    return run


def pack(
    docs: DataFrame,
    path: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    stretch: int = STRETCH,
) -> DataFrame:
    """One row per piece of a document in a sequence: ``doc_id``, ``start``
    (tokens of the document before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (tokens before it in the sequence) and ``ids``
    (little-endian uint32).  Every token, the closing ``end_id`` of each
    document included, is in exactly one piece.

    Null or empty text is a document of the end token alone.  A row is one
    document whatever its id: null and repeated ids pass through.  Other
    columns are ignored.  An empty table gives no rows.  ``path`` is a
    tokenizer file that every executor can open.
    """
    rows = docs.select(q(id_col).cast("long").alias("doc_id"), q(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_packer(path, window, end_id, stretch), PIECES)
