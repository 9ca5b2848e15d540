"""Hashes of byte spans from one running sum, in numpy (all arithmetic modulo 2^64)."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
BYTE_CODES = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64)
BASE = int(_RNG.integers(1 << 40, 1 << 62)) * 2 + 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and its inverse for i < n; kept, and doubled when a longer text comes."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for at, base in enumerate((BASE, INVERSE)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            _powers[at] = p
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def running_sums(raw: np.ndarray) -> np.ndarray:
    """Sums of code(byte i) * BASE^i over each prefix, from the empty one on."""
    up, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODES[raw] * up[: len(raw)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end): equal for equal bytes, wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + np.uint64(0x9E3779B97F4A7C15))
