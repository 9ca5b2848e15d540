"""Word shingles, MinHash signatures and their bands, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

from obsledger.llm.rolling import running_sums, span_hashes

SEED = 20240229
EMPTY = np.uint32(0xFFFFFFFF)
CHUNK = 1 << 9
"""Shingles hashed at a time: permutations x chunk x 8 bytes stay in the processor's cache."""


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text, in order; ASCII white space separates words."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SPACE[raw]
    edge = np.diff(inside)
    return span_hashes(running_sums(raw), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))


def shingle_hashes(text: str, n: int) -> np.ndarray:
    """64-bit hashes of the runs of n words, in order, repeats included.

    A text of fewer words, but at least one, is one shingle; a text without words has none.
    """
    h = word_hashes(text)
    if not len(h):
        return h
    n = min(n, len(h))
    count = len(h) - n + 1
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out ^= h[i : i + count]
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out


@lru_cache(maxsize=4)
def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the universal hashes x -> high half of (a x + b) mod 2^64."""
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, size=count, dtype=np.uint64) * np.uint64(2)
    return a[:, None], b[:, None]


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """MinHash of each permutation as unsigned 32-bit integers; all ones for no shingles."""
    if not len(shingles):
        return np.full(count, EMPTY)
    a, b = permutations(count)
    folded = shingles >> np.uint64(32)  # 32 bits in, 32 high bits out: strongly universal
    least = None
    for at in range(0, len(folded), CHUNK):
        low = (a * folded[None, at : at + CHUNK] + b).min(axis=1)
        least = low if least is None else np.minimum(least, low)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit hash for each band of the signature."""
    raw = np.ascontiguousarray(sig[: bands * rows], "<u4").tobytes()
    width = 4 * rows
    return np.array(
        [xxhash.xxh3_64_intdigest(raw[i * width : (i + 1) * width], i) for i in range(bands)], np.uint64
    ).view(np.int64)


def choose_bands(threshold: float, recall: float, most: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows to a band that still find a pair at ``threshold`` with ``recall``.

    More rows make fewer false candidates and need more bands; ``most`` bounds their product.
    """
    best = None
    for rows in range(1, most + 1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else int(np.ceil(np.log(1 - recall) / np.log(miss)))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError(f"no bands of {most} hashes reach recall {recall} at {threshold}")
    return best
