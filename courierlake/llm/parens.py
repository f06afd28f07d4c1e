"""A tree as balanced parentheses, with block minima and maxima of the excess.

One bit a parenthesis: 1 opens a node, 0 closes it, in preorder. Queries go
through a complete binary tree over blocks that holds each block's least and
greatest excess, and are answered for many positions at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parens:
    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        """``bits``: 1 and 0, balanced."""
        self.bits, self.block = np.asarray(bits, np.int8), block
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        n = max(1, -(-len(self.bits) // block))
        self.leaves = 1 << (n - 1).bit_length()
        # Padding never holds a smaller or greater excess than any query asks.
        filled = np.zeros(self.leaves * block, np.int64)
        filled[:len(self.excess)] = self.excess
        low, high = filled.copy(), filled.copy()
        low[len(self.excess):], high[len(self.excess):] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        self.low = np.concatenate([np.zeros(self.leaves, np.int64), low.reshape(-1, block).min(axis=1)])
        self.high = np.concatenate([np.zeros(self.leaves, np.int64), high.reshape(-1, block).max(axis=1)])
        for i in range(self.leaves - 1, 0, -1):
            self.low[i] = min(self.low[2 * i], self.low[2 * i + 1])
            self.high[i] = max(self.high[2 * i], self.high[2 * i + 1])
        self.opens = np.cumsum(self.bits)
        pairs = np.zeros(len(self.bits), np.int64)
        pairs[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.pairs = np.cumsum(pairs)

    def _scan(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """First position from ``at`` on in its block with excess ``goal``, else -1."""
        found, at = np.full(len(at), -1, np.int64), at.copy()
        ends = np.minimum((at // self.block + 1) * self.block, len(self.excess))
        left = np.flatnonzero(at < ends)
        while len(left):
            hit = self.excess[at[left]] == goal[left]
            found[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < ends[left]]
        return found

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each open one in ``at``."""
        at = np.asarray(at, np.int64)
        goal = self.excess[at] - 1
        out = self._scan(at + 1, goal)
        # An open one that ends its block has nothing to scan in it.
        far = np.flatnonzero(out < 0)
        node = self.leaves + at[far] // self.block
        goal = goal[far]

        def holds(x: np.ndarray) -> np.ndarray:
            return (self.low[x] <= goal) & (goal <= self.high[x])
        # Up until a right sibling holds the excess, then down to its first block.
        up = np.ones(len(far), bool)
        while up.any():
            right = up & (node % 2 == 0)
            here = right.copy()
            here[right] = holds(np.where(right, node + 1, 1))[right]
            node = np.where(here, node + 1, np.where(up, node >> 1, node))
            up &= ~here
        while len(node) and (down := node < self.leaves).any():
            left = np.where(down, 2 * node, 1)
            node = np.where(down, np.where(holds(left), left, left + 1), node)
        out[far] = self._scan((node - self.leaves) * self.block, goal)
        return out

    def rank_pairs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``()`` pairs, which are leaves, that start in [start, end)."""
        return self.pairs[end - 1] - np.where(start > 0, self.pairs[np.maximum(start, 1) - 1], 0)

    def rank_open(self, at: np.ndarray) -> np.ndarray:
        """Open parentheses before each position: a node's place in preorder."""
        return self.opens[at] - self.bits[at]
