"""Canonical Huffman codes of limited length over integer symbols, with vectorised coding of blocks."""

from __future__ import annotations

import numpy as np

MAX_BITS = 18  # with up to 7 bits before it a code fits into 32 bits, and JOINED codes into 64
BLOCK = 128
JOINED = 3


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Bits of each symbol's code, none above ``limit``, so that all symbols together take the fewest bits.

    Package-merge: at each level the symbols, by count, are merged with pairs of the level below. Symbols that do
    not occur get 0 bits; a lone symbol gets 1.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit into {limit} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.float64 if counts.sum() > 2**62 // limit else np.int64)
    levels = []  # at each level, whether an item is a package
    packages = weights[:0]
    for _ in range(limit):
        items = np.concatenate([weights, packages])
        is_package = np.arange(len(items)) >= len(weights)
        rank = np.argsort(items, kind="stable")
        levels.append(is_package[rank])
        items = items[rank]
        packages = items[0 : len(items) // 2 * 2 : 2] + items[1 : len(items) // 2 * 2 : 2]
    take = 2 * len(order) - 2
    for is_package in reversed(levels):
        chosen = is_package[:take]
        n_packages = int(chosen.sum())
        lengths[order[: take - n_packages]] += 1
        take = 2 * n_packages
    return lengths


class Code:
    """The canonical code of given lengths: codes ascend by length, then by symbol."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.bits = max(1, int(self.lengths.max(initial=0)))
        used = np.flatnonzero(self.lengths)
        order = used[np.argsort(self.lengths[used], kind="stable")]
        size = self.lengths[order].astype(np.int64)
        # Left-aligned to the greatest length, codes follow each other by the room they take.
        room = np.int64(1) << (self.bits - size)
        begins = np.concatenate([[0], np.cumsum(room)])[:-1]
        self.codes = np.zeros(len(lengths), np.uint32)  # the code above its length
        self.codes[order] = ((begins >> (self.bits - size) << 5) | size).astype(np.uint32)
        # For any next bits, the symbol in the upper part and its length in the lower.
        self.table = np.zeros(1 << self.bits, np.uint32)
        self.table[: int(room.sum())] = np.repeat((order.astype(np.uint32) << 5) | size.astype(np.uint32), room)

    def encode(self, symbols: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
        """The bits of all symbols, and the bits that each block of symbols takes.

        A few codes in a row are joined to one of up to 64 bits before they are set into place.
        """
        n = len(symbols)
        found = np.zeros(-(-n // JOINED) * JOINED, np.uint64)
        found[:n] = self.codes[symbols]
        size = (found & np.uint64(31)).astype(np.int64)
        if not size[:n].all():
            raise ValueError("a symbol has no code")
        marks = np.add.reduceat(size[:n], np.arange(0, n, block)) if n else size
        found >>= np.uint64(5)
        code, length = found[::JOINED].copy(), size[::JOINED].copy()
        for k in range(1, JOINED):
            code = (code << size[k::JOINED].astype(np.uint64)) | found[k::JOINED]
            length += size[k::JOINED]
        ends = np.cumsum(length)
        total = int(ends[-1]) if n else 0
        words = np.zeros(total // 64 + 2, np.uint64)
        if total:
            begins = ends - length
            word = begins >> 6
            spare = 64 - (begins & 63) - length  # bits left in the word; negative if the code goes on in the next
            part = np.where(
                spare >= 0, code << np.maximum(spare, 0).astype(np.uint64), code >> np.maximum(-spare, 0).astype(np.uint64)
            )
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            words[word[first]] = np.bitwise_or.reduceat(part, first)
            over = np.flatnonzero(spare < 0)
            words[word[over] + 1] |= code[over] << (64 + spare[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[: -(-total // 8)], marks

    def decode(
        self, payload: bytes, marks: np.ndarray, n: int, block: int = BLOCK, first: int = 0, last: int | None = None
    ) -> np.ndarray:
        """The symbols of blocks ``first`` to ``last``; all blocks step together, each from its own bit offset."""
        starts = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[:-1].astype(np.int64)
        last = len(starts) if last is None else last
        counts = np.minimum(block, n - block * np.arange(first, last))
        raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]  # the 32 bits from every byte on
        at = starts[first:last].copy()
        out = np.zeros((block, len(at)), np.uint32)
        shift = np.uint32(32 - self.bits)
        for t in range(int(counts.max(initial=0))):
            if t == counts[-1]:
                at = at[:-1]  # the last block may be short
            entry = self.table[(ahead[at >> 3] << (at & 7).astype(np.uint32)) >> shift]
            out[t, : len(at)] = entry
            at += entry & np.uint32(31)
        return (out >> np.uint32(5)).T.reshape(-1)[: int(counts.sum())]
