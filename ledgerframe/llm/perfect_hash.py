"""A minimal perfect hash of 64-bit keys: each of n keys has a slot of its own below n; other keys have none.

Keys are hashed into a row of bits twice as long as they are many; who is alone on a bit has its place there, the others
go on to the next, shorter row. A slot is the number of set bits before, which a directory and a popcount give. The key
is stored at its slot, so a key that was not given is told from one that was.
"""

from __future__ import annotations

import numpy as np

from .textops import mix

_U = np.uint64


class PerfectHash:
    def __init__(self, keys: np.ndarray):
        """``keys``: different unsigned 64-bit integers."""
        self.rows: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, before = keys, 0
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = self._places(left, len(self.rows), size)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(_U)
            ones = np.bitwise_count(words).astype(np.int64)
            self.rows.append((size, words, before + np.cumsum(ones) - ones))
            before += int(ones.sum())
            left = left[~alone[at]]
        self.keys = np.zeros(len(keys), _U)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _places(keys: np.ndarray, row: int, size: int) -> np.ndarray:
        h = mix(keys ^ _U(row * 0x9E3779B97F4A7C15 + 0x243F6A8885A308D3 & (1 << 64) - 1))
        return ((h >> _U(32)) * _U(size) >> _U(32)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key that was given; anything, or -1, for others."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (size, words, before) in enumerate(self.rows):
            at = self._places(keys[open_], k, size)
            word, bit = words[at >> 6], (at & 63).astype(_U)
            hit = (word >> bit & _U(1)).astype(bool)
            below = np.bitwise_count(word[hit] & (_U(1) << bit[hit]) - _U(1))
            out[open_[hit]] = before[at[hit] >> 6] + below
            open_ = open_[~hit]
            if not len(open_):
                break
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for those that the hash wasn't made of: the stored key decides."""
        out = self._slots(keys)
        if len(self.keys):
            out[self.keys[out] != keys] = -1
        return out
