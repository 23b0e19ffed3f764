"""Words of many texts at once, as byte ranges and as 64-bit hashes."""

from __future__ import annotations

import numpy as np

import xxhash

from lapstar.llm.common import mix

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RANDOM = np.random.default_rng(20240229)
BYTE_VALUE = _RANDOM.integers(0, 2**64, (2, 256), np.uint64)
BASE = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
CHUNK = 1 << 20
LONG_WORD = 32
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """For both bases, their powers and the inverses' powers up to ``CHUNK``, modulo 2**64."""
    if not _POWERS or len(_POWERS[0][0]) != CHUNK + 1:
        _POWERS.clear()
        for base in BASE:
            rows = []
            for factor in (base, pow(base, -1, 2**64)):
                row = np.full(CHUNK + 1, factor, np.uint64)
                row[0] = 1
                rows.append(np.cumprod(row, dtype=np.uint64))
            _POWERS.append((rows[0], rows[1]))
    return _POWERS


class Ranges:
    """Hashes of any byte ranges of a buffer, from sums over the prefixes of its chunks.

    The powers start anew with each chunk, so their tables are as long as a chunk, whatever the buffer. The sums are
    modulo 2**64: long strings of a regular build may agree (two Thue-Morse words from 1,024 bytes on), so ranges of any
    length are put together from names of short ones (``suffixes``), and words go through ``word_hashes``.
    """

    def __init__(self, data: np.ndarray, which: int = 0):
        self.base = BASE[which]
        self.up, self.down = powers()[which]
        self.size = len(data)
        self.sums = np.zeros(len(data) + 1, np.uint64)  # of the own chunk's bytes before each position
        self.totals = np.zeros(len(data) // CHUNK + 1, np.uint64)
        for k in range(len(self.totals)):
            part = data[k * CHUNK : (k + 1) * CHUNK]
            sums = np.cumsum(BYTE_VALUE[which][part] * self.up[: len(part)], dtype=np.uint64)
            self.sums[k * CHUNK + 1 : k * CHUNK + len(part) + 1] = sums
            if len(part) == CHUNK:
                self.totals[k], self.sums[(k + 1) * CHUNK] = sums[-1], 0

    def _sums(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.size < CHUNK:
            return (self.sums[ends] - self.sums[starts]) * self.down[starts]
        first, last = starts // CHUNK, ends // CHUNK
        out = (np.where(first == last, self.sums[ends], self.totals[first]) - self.sums[starts]) * self.down[starts % CHUNK]
        over = np.flatnonzero(last == first + 1)
        out[over] += self.sums[ends[over]] * self.up[last[over] * CHUNK - starts[over]]
        for i in np.flatnonzero(last > first + 1).tolist():
            found, begin = int(out[i]), int(starts[i])
            for k in range(int(first[i]) + 1, int(last[i]) + 1):
                some = self.totals[k] if k < last[i] else self.sums[ends[i]]
                found += int(some) * pow(self.base, k * CHUNK - begin, 2**64)
            out[i] = found % 2**64
        return out

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self._sums(starts, ends) + (ends - starts).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """The plain sums of the ``size`` bytes from every position on, as many as fit."""
        n = max(0, self.size - size + 1)
        if self.size < CHUNK:
            return (self.sums[size : size + n] - self.sums[:n]) * self.down[:n]
        out = np.empty(n, np.uint64)
        for begin in range(0, n, CHUNK):
            at = np.arange(begin, min(n, begin + CHUNK))
            out[begin : begin + CHUNK] = self._sums(at, at + size)
        return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words: of long ones by xxhash, as sums of powers tell those of a regular build badly apart."""
    out = Ranges(data)(starts, np.minimum(ends, starts + LONG_WORD))
    long = np.flatnonzero(ends - starts > LONG_WORD)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        places = zip(starts[long].tolist(), ends[long].tolist(), strict=True)
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(raw[b:e]) for b, e in places), np.uint64, len(long))
    return out


def word_ranges(offsets: np.ndarray, inside: np.ndarray, alone: np.ndarray | None = None):
    """Starts and ends of maximal runs of ``inside`` bytes; runs end with their text, ``alone`` bytes are words."""
    n = len(inside)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    begins = inside & (~before | border[:n])
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = inside & (~after | border[1:])
    if alone is not None:
        begins |= alone
        ends |= alone
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def text_of(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The text that holds each position."""
    return np.searchsorted(offsets, positions, "right") - 1
