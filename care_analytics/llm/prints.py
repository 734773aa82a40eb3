"""Polynomial fingerprints of byte spans, by prefix sums over whole blocks."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 17


class Fingerprints:
    """Fingerprints modulo 2^64 over random odd codes of the byte values; equal bytes give equal numbers anywhere."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 58, 1 << 60)) * 8 + 5
        self.size = 0

    def _powers(self, n: int) -> None:
        if n > self.size:
            self.size = n
            self.power, self.inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(b))]), dtype=np.uint64)
                                        for b in (self.base, pow(self.base, -1, 1 << 64)))

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of ``data[s:e]`` for ascending ``starts`` and ``ends``."""
        out = np.empty(len(starts), np.uint64)
        a = 0
        while a < len(starts):
            at = int(starts[a])
            b = int(np.searchsorted(starts, at + CHUNK))
            part = data[at:int(ends[b - 1])]
            self._powers(max(len(part), CHUNK))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.codes[part] * self.power[:len(part)], out=sums[1:])
            local = starts[a:b] - at
            out[a:b] = (sums[ends[a:b] - at] - sums[local]) * self.inverse[local]
            a = b
        return mixed(out)

    def windows(self, data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
        return self.spans(data, starts, starts + width)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits (in place)."""
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_PRINTS: dict[int, Fingerprints] = {}


def prints(seed: int) -> Fingerprints:
    """The fingerprints of this Python worker."""
    if seed not in _PRINTS:
        _PRINTS[seed] = Fingerprints(seed)
    return _PRINTS[seed]
