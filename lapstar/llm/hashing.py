"""A fixed table of 64-bit keys that is looked up for many keys at once."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Open addressing over arrays; keys are distinct and not negative."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]
            placed = self.keys[slot[left]] == keys[left]
            self.values[slot[left[placed]]] = values[left[placed]]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _ODD) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1).astype(np.int64)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out
