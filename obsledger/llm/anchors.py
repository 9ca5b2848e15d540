"""Content-defined anchors of a byte string, in numpy.

A gram is ``GRAM`` bytes; the minimizer of ``width`` consecutive grams is the
one with the smallest hash, the leftmost of equals. Equal stretches of bytes
have their minimizers at equal places, so a repeated string is cut alike
wherever it stands. Neighbouring anchors are at most ``width`` bytes apart.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from obsledger.llm.rolling import powers, span_hashes

GRAM = 16


def width_for(length: int) -> int:
    """The largest power of two for which every string of ``length`` bytes holds a whole phrase
    after its first anchor, whatever surrounds it."""
    if length < GRAM + 1:
        raise ValueError(f"strings must have {GRAM + 1} bytes or more")
    return 1 << (((length - GRAM + 2) // 3).bit_length() - 1)


class Anchors(NamedTuple):
    """Anchors of one text. A window of ``length`` bytes belongs to the minimizer of its first grams:
    anchor i has the windows that start in [first[i], last[i]] (first > last: none)."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchors_of(sums: np.ndarray, length: int, width: int) -> Anchors | None:
    """Anchors of the text with these running sums; None if it is shorter than ``length``."""
    n = len(sums) - 1
    if n < length:
        return None
    _, down = powers(n + 1)
    grams = (sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1] * np.uint64(0xFF51AFD7ED558CCD)
    low = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    best = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(best)) + 1
    begin = np.concatenate([[0], change])
    end = np.concatenate([change - 1, [len(best) - 1]])
    last_start = n - length
    return Anchors(best[begin], begin, np.minimum(end, last_start))


def phrase_hashes(sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each anchor but the last to the end of the next anchor's gram."""
    return span_hashes(sums, at[:-1], at[1:] + GRAM)
