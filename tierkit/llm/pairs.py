"""Pair merging of many short pieces at once, in array operations."""

from __future__ import annotations

import numpy as np

_BITS = 20
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FREE = -1


class PairTable:
    """Rank and merged id of adjacent token pairs, in an open hash table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.none = int(rank.max()) + 1
        self.merged = np.zeros(self.none + 1, np.int64)
        self.merged[rank] = merged
        bits = max(_BITS, int(len(rank)).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, _FREE, np.int64)
        self.ranks = np.full(1 << bits, self.none, np.int64)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slots, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            at, one = np.unique(slots[todo], return_index=True)
            at, one = at[self.keys[at] == _FREE], one[self.keys[at] == _FREE]
            self.keys[at], self.ranks[at] = keys[todo[one]], rank[todo[one]]
            rest = np.ones(len(todo), bool)
            rest[one] = False
            todo = todo[rest]
            slots[todo] = (slots[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _FACTOR) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair; ``none`` for a pair that does not merge."""
        keys = left << 32 | right
        at = self._slot(keys)
        found = self.keys[at]
        out = self.ranks[at]
        todo = np.flatnonzero((found != keys) & (found != _FREE))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            found = self.keys[at[todo]]
            out[todo] = self.ranks[at[todo]]
            todo = todo[(found != keys[todo]) & (found != _FREE)]
        found = self.keys[at]
        out[found != keys] = self.none
        return out


def merge(ids: np.ndarray, lens: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every piece (``lens`` ids each, none empty) to the end.

    Each step merges the leftmost pair of least rank of every piece that has
    one.  Returns the ids of all pieces in order and their number per piece."""
    ids = ids.astype(np.int64)
    owner = np.repeat(np.arange(len(lens)), lens)
    none = table.none
    rank = np.full(len(ids), none, np.int64)  # of the pair that begins at each id
    rank[:-1] = table.rank(ids[:-1], ids[1:])
    rank[np.cumsum(lens) - 1] = none
    done_ids, done_owner = [], []
    while len(ids):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), starts)
        found = best >> 32 < none
        at = best[found] & 0xFFFFFFFF
        ids[at] = table.merged[best[found] >> 32]
        keep = np.ones(len(ids), bool)
        if found.all():
            keep[at + 1] = False
        else:
            more = np.repeat(found, np.diff(starts, append=len(ids)))
            done_ids.append(ids[~more])
            done_owner.append(owner[~more])
            keep[at + 1] = False
            keep &= more
        if not len(at):
            break
        moved = np.cumsum(keep)[at] - 1
        ids, owner, rank = ids[keep], owner[keep], rank[keep]
        for x in (moved, moved[moved > 0] - 1):
            inner = x[x + 1 < len(ids)]
            inner = inner[owner[inner] == owner[inner + 1]]
            rank[x] = none
            rank[inner] = table.rank(ids[inner], ids[inner + 1])
    owner = np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(done_ids)[order], np.bincount(owner, minlength=len(lens))
