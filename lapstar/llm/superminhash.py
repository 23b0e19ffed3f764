"""SuperMinHash signatures of many sets at once.

Every member deals its values to the slots by a permutation of its own: to the slot of rank j it offers j plus a
fraction. A slot keeps the least value offered. So a member's values are spread over the slots without repetition,
which makes signatures vary less than with independent values; and no member of rank j + 1 can lower a slot that
already holds less than j + 1, so a set is done as soon as all its slots do. Ranks are dealt for all sets together,
rank by rank; sets that are done leave.
"""

from __future__ import annotations

import numpy as np

from lapstar.llm.common import mix

_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _draw(members: np.ndarray, rank: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each member its value at a rank, rank and fraction in one number, and the place of the swap."""
    drawn = mix(members + np.uint64((rank + 1) * _STEP % 2**64))
    value = (drawn & _LOW) | np.uint64(rank << 32)
    place = rank + (((drawn >> _HALF) * np.uint64(slots - rank)) >> _HALF).astype(np.int64)
    return value, place


def signatures(members: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """One row of ``slots`` values per set; all ones for an empty set."""
    n = len(bounds) - 1
    found = np.full(n * slots, np.iinfo(np.uint64).max, np.uint64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    value, place = _draw(members, 0, slots)
    np.minimum.at(found, owner * slots + place, value)
    ranks = found.reshape(n, slots)
    open_ = (sizes > 0) & (ranks.max(1, initial=0) >= np.uint64(1 << 32))
    order: np.ndarray | None = None
    for rank in range(1, slots):
        keep = open_[owner]
        if not keep.any():
            break
        if order is None:  # the members' permutations, with the swap of rank 0 done
            members, owner, place = members[keep], owner[keep], place[keep]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(members), 1))
            rows = np.arange(len(members))
            order[rows, 0], order[rows, place] = place, 0
        elif not keep.all():
            members, owner, order = members[keep], owner[keep], order[keep]
        value, place = _draw(members, rank, slots)
        rows = np.arange(len(members))
        slot = order[rows, place]
        order[rows, place] = order[:, rank]
        order[:, rank] = slot
        np.minimum.at(found, owner * slots + slot, value)
        open_ &= ranks.max(1, initial=0) >= np.uint64((rank + 1) << 32)
    return ranks


def bands(rows: np.ndarray, per_band: int) -> np.ndarray:
    """A 64-bit key for each run of ``per_band`` slots, which also tells the band."""
    n, slots = rows.shape
    parts = rows.reshape(n, slots // per_band, per_band)
    key = np.broadcast_to(np.arange(slots // per_band, dtype=np.uint64) * np.uint64(_STEP), parts.shape[:2]).copy()
    for k in range(per_band):
        key = mix(key + parts[:, :, k])
    return key.view(np.int64)
