"""Edit strings that share their beginnings, compared without spelling them out.

A string is a node: its last letter, the node of the string before it, and a
hash of the whole.  Ancestors at distances of powers of two let two strings be
brought to one length and their longest common prefix be searched by hashes;
what hashes call equal is verified on the letters.
"""

from __future__ import annotations

PRIME = (1 << 61) - 1
BASE = 0x1F3D5B79A1C2E4


class Trails:
    """Nodes by number; 0 is the empty string."""

    def __init__(self, base: int = BASE, prime: int = PRIME):
        self.base, self.prime = base, prime
        self.letter, self.depth, self.hash = [""], [0], [0]
        #: Ancestors 1, 2, 4, ... letters before a node.
        self.up: list[list[int]] = [[]]

    def grow(self, node: int, letter: str) -> int:
        """The string of ``node`` and one letter more."""
        up, step = [node], 0
        while step < len(self.up[up[-1]]):
            up.append(self.up[up[-1]][step])
            step += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(letter) + 1) % self.prime)
        self.up.append(up)
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        """The first ``depth`` letters of a string that has as many."""
        back, step = self.depth[node] - depth, 0
        while back:
            if back & 1:
                node = self.up[node][step]
            back, step = back >> 1, step + 1
        return node

    def _same(self, a: int, b: int) -> bool:
        """True if two strings of one length are letter for letter the same;
        a shared beginning is reached by both and needs no look."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def _first_difference(self, a: int, b: int) -> tuple[int, int]:
        """Nodes of the first differing letters, letter by letter."""
        found = (a, b)
        while a != b:
            if self.letter[a] != self.letter[b]:
                found = (a, b)
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, a: int, b: int) -> bool:
        """True if the string of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x == y or (self.hash[x] == self.hash[y] and self._same(x, y)):
            return self.depth[a] < self.depth[b]
        top, bottom = x, y
        for step in range(len(self.up[x]) - 1, -1, -1):
            if step < len(self.up[x]):
                p, r = self.up[x][step], self.up[y][step]
                if self.hash[p] != self.hash[r]:
                    x, y = p, r
        # Their parents' hashes agree: the longest common prefix, if no collision.
        if self.letter[x] == self.letter[y] or not self._same(self.up[x][0], self.up[y][0]):
            x, y = self._first_difference(top, bottom)
        return self.letter[x] < self.letter[y]

    def spell(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))
