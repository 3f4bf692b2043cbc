"""A minimal perfect hash over a set of 16-byte keys.

Keys fall into a bit array by a hash of the level; those that fall alone take a slot, those that
collide go on to the next level (Limasset et al., 2017). A slot is the rank of the key's bit. The keys
are kept beside the slots, so every lookup is verified.
"""

from __future__ import annotations

import numpy as np

from wattline.llm.words import mixed

#: Bits per key of a level.
LOAD = 2
_GOLDEN = 0x9E3779B97F4A7C15


class SlotTable:
    """Slots 0 to n - 1 of n distinct keys, given as an (n, 2) array of unsigned 64-bit numbers."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []  # first slot, rank per place (-1: no key alone)
        left, first = np.arange(len(keys)), 0
        slots = np.empty(len(keys), np.int64)
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("keys repeat")
            place = self._place(keys[left], len(self.levels), LOAD * len(left))
            alone = np.bincount(place, minlength=LOAD * len(left)) == 1
            rank = np.where(alone, np.cumsum(alone) - 1, -1)
            self.levels.append((first, rank))
            taken = alone[place]
            slots[left[taken]] = first + rank[place[taken]]
            first += int(alone.sum())
            left = left[~taken]
        self.keys = np.empty_like(keys)
        self.keys[slots] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(_GOLDEN * (level + 1) & (1 << 64) - 1)
        return (mixed(keys[:, 0] ^ mixed(keys[:, 1] + salt)) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, verified against the key that is kept there; -1 for keys not in the set."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (first, rank) in enumerate(self.levels):
            at = rank[self._place(keys[left], level, len(rank))]
            out[left[at >= 0]] = first + at[at >= 0]
            left = left[at < 0]
        known = out >= 0
        wrong = np.flatnonzero(known)[(self.keys[out[known]] != keys[known]).any(axis=1)]
        out[wrong] = -1
        return out
