"""Buckets of text positions by the bytes that follow, refined by the buckets of later positions.

A position's bucket at the first level is its q-gram. The bucket for twice the length is named by the bucket of the
position and the bucket of the position that many bytes later, and so on: each level reuses the names of the one before.
Names are 64-bit mixes of what they stand for, so positions in different documents get the same name for the same bytes
without being sorted together; what is compared over the corpus are the names.

Not every position is compared. ``anchors`` picks, for every string of ``LENGTH`` bytes, the first q-gram in it with the
least name. Equal strings pick it at the same place, so strings can only be equal if their anchors share a bucket.
"""

from __future__ import annotations

import numpy as np

from lapstar.llm.common import mix
from lapstar.llm.words import Ranges

GRAM = 64
LENGTH = 400
REACH = LENGTH - GRAM  # an anchor lies 0 to REACH bytes behind its string's begin
_LATER = np.uint64(0xC2B2AE3D27D4EB4F)


class Buckets:
    """Names of the buckets of a buffer's positions, level by level."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.ranges = Ranges(data, which)

    def grams(self) -> np.ndarray:
        """The first level's name of every position."""
        return mix(self.ranges.windows(GRAM))

    def level(self, k: int, at: np.ndarray) -> np.ndarray:
        """Names for the ``GRAM * 2**k`` bytes from these positions on."""
        if k == 0:
            return mix(self.ranges._sums(at, at + GRAM))
        return mix(self.level(k - 1, at) * _LATER + self.level(k - 1, at + (GRAM << (k - 1))))

    def names(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Names of the strings of at least ``GRAM`` bytes between these positions: of each, the greatest bucket that
        fits at its begin and the one that ends with it."""
        size = ends - begins
        out = np.zeros(len(begins), np.uint64)
        for k in range(int(size.max(initial=0) // GRAM).bit_length()):
            now = np.flatnonzero((size >= GRAM << k) & (size < GRAM << (k + 1)))
            if len(now):
                first, last = self.level(k, begins[now]), self.level(k, ends[now] - (GRAM << k))
                out[now] = mix(first * _LATER + last + size[now].astype(np.uint64))
        return out


def anchors(names: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``LENGTH`` bytes: their positions, and the first and last begin of their strings.

    ``names`` has the first level's name of each position; strings do not cross the texts between ``offsets``.
    """
    n = len(names)
    none = np.zeros(0, np.int64)
    if n <= REACH:
        return none, none, none
    width = REACH + 1
    bits = np.uint64(int(n).bit_length())
    order = (names >> bits << bits) | np.arange(n, dtype=np.uint64)  # equal names: the first
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = order
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: n - REACH], ahead[REACH:n])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # Only strings inside one text count.
    inside = np.zeros(len(at) + 1, np.int64)
    begins, ends = offsets[:-1], np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
    some = ends > begins
    np.add.at(inside, np.minimum(begins[some], len(at)), 1)
    np.add.at(inside, np.minimum(ends[some], len(at)), -1)
    valid = np.cumsum(inside[:-1]) > 0
    fresh = valid.copy()
    fresh[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    border = np.zeros(len(at), bool)
    border[begins[some]] = True
    fresh |= border & valid
    first = np.flatnonzero(fresh)
    closing = valid.copy()
    closing[:-1] &= fresh[1:] | ~valid[1:]
    last = np.flatnonzero(closing)
    return at[first], first, last
