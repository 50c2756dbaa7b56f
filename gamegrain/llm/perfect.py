"""Minimal perfect hash over distinct 128-bit keys, in levels of collision-free bits."""

from __future__ import annotations

import struct

import numpy as np

GAMMA = 2.0
MAX_LEVELS = 64
MASK = (1 << 64) - 1
STEP, MIX = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD


def _positions(low: np.ndarray, high: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (low ^ np.uint64((level + 1) * STEP & MASK)) * np.uint64(MIX)
    x = ((x ^ (x >> np.uint64(32))) + high) * np.uint64(MIX)
    return ((x >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)


class PerfectHash:
    """``n`` keys to ``n`` slots without gaps. A key that was not in the set gets some slot or -1: compare what the
    slot holds."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sizes = [int(bits.sum()) for bits in levels]
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = [np.cumsum(bits, dtype=np.int64) - 1 + starts[i] for i, bits in enumerate(levels)]
        self.n = int(starts[-1])

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray) -> PerfectHash:
        """Each level keeps the keys that are alone at their position; the others go to the next level."""
        levels: list[np.ndarray] = []
        while len(low):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = max(4, int(GAMMA * len(low)))
            at = _positions(low, high, len(levels), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(alone)
            left = ~alone[at.astype(np.int64)]
            low, high = low[left], high[left]
        return cls(levels)

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.full(len(low), -1, np.int64)
        open_ = np.arange(len(low))
        for i, bits in enumerate(self.levels):
            at = _positions(low[open_], high[open_], i, len(bits)).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.ranks[i][at[hit]]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<I", len(self.levels))]
        for bits in self.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        (count,), at, levels = struct.unpack_from("<I", data), 4, []
        for _ in range(count):
            (size,) = struct.unpack_from("<Q", data, at)
            at += 8
            used = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, used, at), count=size).astype(bool))
            at += used
        return cls(levels)
