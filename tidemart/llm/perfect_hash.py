"""A minimal perfect hash over 64-bit keys, built and probed in numpy.

Level by level, each key left over sets a slot of a bit array; keys alone in their slot stay there,
the others go on to the next level.  The rank of a key's bit is its index.
"""

from __future__ import annotations

import numpy as np

from tidemart.llm.grams import mix

#: Slots per key on each level.
LOAD = 2.0
_STEP = 0x9E3779B97F4A7C15


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64((level + 1) * _STEP % (1 << 64))) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> tuple[list[int], bytes]:
    """Sizes of the levels and all their bits, for distinct keys."""
    sizes, bits = [], []
    while len(keys):
        size = (int(len(keys) * LOAD) // 8 + 1) * 8
        slots = _slots(keys, len(sizes), size)
        alone = np.bincount(slots, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little"))
        keys = keys[~alone[slots]]
    return sizes, b"".join(b.tobytes() for b in bits)


class PerfectHash:
    """Index of each key in 0 .. n - 1; a key that was not built in gets any index, or -1."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        self.ranks = np.cumsum(self.bits, dtype=np.int64) - 1

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            slots = base + _slots(keys[left], level, size)
            hit = self.bits[slots]
            out[left[hit]] = self.ranks[slots[hit]]
            left, base = left[~hit], base + size
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    """Sixteen bits of each key, independent of its slots."""
    return (mix(keys ^ np.uint64(_STEP)) >> np.uint64(48)).astype(np.uint16)
