"""Byte-pair merges: which tokens may stand next to each other, and last tokens of prefixes.

A merge vocabulary gives every token a rank; encoding merges the adjacent pair whose
union ranks first, leftmost on ties, until none is left. Every prefix of a text has
exactly one last token that encoding it alone would end with, and that token follows
from the last tokens of shorter prefixes: it ends the prefix, and stays apart from the
last token before it. So one pass over a text stores one token per prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

NONE = np.iinfo(np.int32).max


class Merges:
    """Tokens (bytes or str) in rank order; single symbols need no merge."""

    def __init__(self, tokens: Sequence):
        self.tokens = list(tokens)
        self.rank = {token: i for i, token in enumerate(self.tokens)}
        self.longest = max(map(len, self.tokens), default=1)
        n = len(self.tokens)
        #: The rank at which a token is made; -1 for single symbols.
        self.made = np.full(n, -1, np.int64)
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        #: Tokens that encoding can give; a token whose own symbols merge otherwise can't.
        self.usable = np.ones(n, bool)
        for i, token in enumerate(self.tokens):
            if len(token) > 1:
                parts = self._last_two(token)
                self.usable[i] = parts is not None
                if parts:
                    self.made[i], (self.left[i], self.right[i]) = i, parts
        made = np.flatnonzero(self.made >= 0)
        keys = self.left[made] << 32 | self.right[made]
        order = np.argsort(keys)
        self._pairs, self._joined = keys[order], made[order]
        self._at, self._inner = self.made.tolist(), list(zip(self.left.tolist(), self.right.tolist()))
        self._joins = {self._inner[i]: i for i in made.tolist()}
        self._seen = np.zeros(1 << 21, np.int64)
        self._fits = np.zeros(1 << 21, bool)

    def merge(self, text) -> list:
        """Plain merging, the definition of the encoding."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _last_two(self, token) -> tuple[int, int] | None:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == NONE:
                return None
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        pair = tuple(self.rank.get(p, -1) for p in parts)
        return None if -1 in pair else pair

    def apart(self, u: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether encoding leaves token `u` directly before token `t`."""
        keys = u.astype(np.int64) << 32 | t.astype(np.int64)
        slot = ((keys * 0x9E3779B1 ^ keys >> 15) & 0x1FFFFF).astype(np.int64)
        miss = np.flatnonzero(self._seen[slot] != keys + 1)
        out = self._fits[slot]
        if miss.size:
            few, back = np.unique(keys[miss], return_inverse=True)
            fits = self._undo(few >> 32, few & 0xFFFFFFFF)
            out[miss] = fits[back]
            self._seen[slot[miss]], self._fits[slot[miss]] = keys[miss] + 1, out[miss]
        return out

    def _undo(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Take merges back, latest first, at the two sides of the border.

        Before each merge taken back, the parts at the border must not have merged
        with each other at an earlier rank. The border lies right of the merges on its
        left, so those win ties against it, and it wins ties against those on its right.
        """
        out, live = np.ones(len(x), bool), np.arange(len(x))
        bound = np.full(len(x), NONE, np.int64)
        while live.size:
            key = x << 32 | y
            at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
            joined = np.where(self._pairs[at] == key, self._joined[at], NONE)
            crossed = joined < bound
            out[live[crossed]] = False
            a, b = self.made[x], self.made[y]
            go = ~crossed & ((a >= 0) | (b >= 0))
            live, x, y, a, b = live[go], x[go], y[go], a[go], b[go]
            on_left = a > b
            bound = np.where(on_left, a, b + 1)
            x, y = np.where(on_left, self.right[x], x), np.where(on_left, y, self.left[y])
        return out

    def fits(self, x: int, y: int) -> bool:
        """`apart` of one pair."""
        bound = NONE
        while True:
            if self._joins.get((x, y), NONE) < bound:
                return False
            a, b = self._at[x], self._at[y]
            if a < 0 and b < 0:
                return True
            if a > b:
                bound, x = a, self._inner[x][1]
            else:
                bound, y = b + 1, self._inner[y][0]
