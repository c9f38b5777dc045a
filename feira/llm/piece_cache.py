"""Small tables of what a tokenizer makes of pieces of text, for whole-array lookups.

A piece is known by two 64-bit hashes of its bytes. Its slot in a table follows from the first;
a piece that comes to a taken slot takes it over. So a table has the size it is made with,
whatever is looked up, and says of a piece either what was stored for it or nothing.
"""

from __future__ import annotations

import numpy as np

LONGEST = 64  # bytes of a piece that is kept in a table
LOOKED_UP = 1 << 17  # bytes of text whose pieces are looked up at once, or one longer text

_RANDOM = np.random.default_rng(20250131)
_VALUES = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64)
_POWERS = np.array([[pow(int(b) | 1, k, 2**64) for k in range(LONGEST)] for b in _RANDOM.integers(2**60, 2**63, 2)], np.uint64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, at): at holds starts[i], starts[i] + 1, ... for each i, from place first[i] on."""
    first = np.cumsum(sizes) - sizes
    return first, np.arange(int(sizes.sum())) + np.repeat(starts - first, sizes)


def hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(2, pieces): the hashes of pieces of 1 to LONGEST bytes."""
    out = np.empty((2, len(starts)), np.uint64)
    if not len(starts):
        return out
    first, at = ranges(starts, sizes)
    place = at - np.repeat(starts, sizes)
    raw = data[at]
    for k in range(2):
        out[k] = np.add.reduceat(_VALUES[k][raw] * _POWERS[k][place], first)
        out[k] ^= out[k] >> np.uint64(32)
        out[k] *= np.uint64(0x9E3779B97F4A7C15)
    return out


class Table:
    """2**bits slots for pieces, each with a size and up to `width` numbers."""

    def __init__(self, bits: int, width: int = 0) -> None:
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros((2, 1 << bits), np.uint64)
        self.sizes = np.full(1 << bits, -1, np.int32)
        self.values = np.zeros((1 << bits, width), np.uint32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each piece, -1 for unknown ones."""
        slot = (keys[0] >> self.shift).astype(np.int64)
        hit = (self.keys[0][slot] == keys[0]) & (self.keys[1][slot] == keys[1]) & (self.sizes[slot] >= 0)
        return np.where(hit, slot, -1)

    def store(self, keys: np.ndarray, sizes: np.ndarray, values: np.ndarray | None = None) -> None:
        slot, last = np.unique((keys[0] >> self.shift)[::-1].astype(np.int64), return_index=True)
        last = keys.shape[1] - 1 - last  # of pieces that share a slot only one is stored
        self.keys[:, slot] = keys[:, last]
        self.sizes[slot] = sizes[last]
        if values is not None:
            self.values[slot] = values[last]

    def nbytes(self) -> int:
        return self.keys.nbytes + self.sizes.nbytes + self.values.nbytes


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each different piece is first, the number of each piece among them)."""
    _, first, number = np.unique(keys[0] ^ (keys[1] >> np.uint64(1)), return_index=True, return_inverse=True)
    return first, number.reshape(-1)
