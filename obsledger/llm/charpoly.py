"""Exact characteristic polynomials of integer matrices, their real roots, and null vectors.

The polynomial is found modulo many primes by reduction to Hessenberg form, the primes of a task side
by side in numpy, and put together by Chinese remaindering. The matrices are symmetric without negative
eigenvalues, so every root is real, and the sign changes in the coefficients of p(x + a) are exactly as many as
the roots above a. Everything but the last rounding to doubles is integer arithmetic.
"""

from __future__ import annotations

from itertools import accumulate
from math import comb, isqrt, prod
from typing import NamedTuple

import numpy as np

ROOT_BITS = 256
"""A root is known to 2^-256 of itself; closer ones are one root of several components."""
WORK_BITS = 640
"""Fraction bits of the eliminations that give the components."""
ITERATIONS = 3


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.2e9."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31, as many as their product needs to exceed ``bound``."""
    found, product, n = [], 1, (1 << 31) + 1
    while product <= bound:
        n -= 2
        if is_prime(n):
            found.append(n)
            product *= n
    return found


def coefficient_bound(matrix: list[list[int]]) -> int:
    """No coefficient is larger: the mean of the products of k roots is at most the k-th power of the mean root."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d) if d else 0
    return max(comb(d, k) * mean**k for k in range(d + 1))


def modular_polynomials(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients of det(t - matrix) modulo each prime, the highest power first: (primes, d + 1)."""
    d, m = len(matrix), len(primes)
    p = np.array(primes, np.int64)
    h = np.array([[[x % q for x in row] for row in matrix] for q in primes], np.int64).reshape(m, d, d)
    each, p1, p2 = np.arange(m), p[:, None], p[:, None, None]
    for k in range(1, d - 1):
        pivot = k + (h[:, k:, k - 1] != 0).argmax(axis=1)
        h[each, k], h[each, pivot] = h[each, pivot].copy(), h[each, k].copy()
        h[each, :, k], h[each, :, pivot] = h[each, :, pivot].copy(), h[each, :, k].copy()
        # pow(0, -1) has no value; a column that is 0 below the diagonal needs none.
        inverse = np.array([pow(int(x), -1, q) if x else 0 for x, q in zip(h[:, k, k - 1], primes, strict=True)])
        u = h[:, k + 1 :, k - 1] * inverse[:, None] % p1
        h[:, k + 1 :] = (h[:, k + 1 :] - u[:, :, None] * h[:, k : k + 1] % p2) % p2
        h[:, :, k] = (h[:, :, k] + (h[:, :, k + 1 :] * u[:, None] % p2).sum(axis=2)) % p1
    # polys[:, k] is the polynomial of the leading k rows and columns, the lowest power first.
    polys = np.zeros((m, d + 1, d + 1), np.int64)
    polys[:, 0, 0] = 1
    for k in range(1, d + 1):
        weights = np.zeros((m, k), np.int64)
        below = np.ones(m, np.int64)
        for i in range(k - 1, -1, -1):
            weights[:, i] = h[:, i, k - 1] * below % p
            if i:
                below = below * h[:, i, i - 1] % p
        taken = (weights[:, :, None] * polys[:, :k] % p2).sum(axis=1)
        polys[:, k, 1:] = polys[:, k - 1, :-1]
        polys[:, k] = (polys[:, k] - taken) % p1
    return polys[:, d, ::-1]


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The integers of least size with these residues (prime -> one residue for each integer)."""
    whole = prod(residues)
    parts = {q: whole // q * pow(whole // q, -1, q) for q in residues}
    sums = [sum(parts[q] * r[k] for q, r in residues.items()) % whole for k in range(len(next(iter(residues.values()))))]
    return [s - whole if 2 * s > whole else s for s in sums]


class Root(NamedTuple):
    """A root in (low, high] / 2^shift; ``above`` roots are larger, ``many`` are inside."""

    low: int
    high: int
    shift: int
    above: int
    many: int


def roots_above(coefficients: list[int], m: int, shift: int) -> int:
    """How many roots of a polynomial whose roots are all real exceed m / 2^shift (m >= 0)."""
    d = len(coefficients) - 1
    if m:
        # The same signs as p(x + a): the argument stretched so that a is 1, then moved by 1.
        row = [c * m ** (d - k) << shift * k for k, c in enumerate(coefficients)]
        for k in range(d):
            row[: d + 1 - k] = accumulate(row[: d + 1 - k])
    else:
        row = coefficients
    signs = [c > 0 for c in row if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(coefficients: list[int], m: int, shift: int) -> int:
    total = 0
    for k, c in enumerate(coefficients):
        total = total * m + (c << shift * k)
    return (total > 0) - (total < 0)


def root_number(coefficients: list[int], k: int, bits: int = ROOT_BITS) -> Root | None:
    """The k-th largest root, known to 2^-bits of itself; None if it is not positive."""
    above = roots_above(coefficients, 0, 0)
    if above < k:
        return None
    low, high, shift = 0, 1, 0
    at_low, at_high = above, roots_above(coefficients, high, 0)
    while at_high >= k:
        low, high, at_low = high, 2 * high, at_high
        at_high = roots_above(coefficients, high, 0)
    while (high - low) << bits > low:
        if high - low == 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        middle = (low + high) // 2
        if at_low - at_high > 1:
            found = roots_above(coefficients, middle, shift)
        else:
            # One simple root inside: p has the sign of (-1)^at_high above it, the other below.
            sign = sign_at(coefficients, middle, shift)
            found = at_low if sign * (-1) ** at_high < 0 else at_high
        if found >= k:
            low, at_low = middle, found
        else:
            high, at_high = middle, found
    return Root(low, high, shift, at_high, at_low - at_high)


def null_vectors(matrix: list[list[int]], root: Root, bits: int = WORK_BITS) -> list[list[float]]:
    """Orthogonal unit vectors of the root's null space, as many as it has, by inverse iteration."""
    d, one = len(matrix), 1 << bits
    value = ((root.low + root.high) << bits) >> (root.shift + 1)
    rows = np.array([[x << bits for x in row] for row in matrix], object)
    for i in range(d):
        rows[i, i] -= value
    # Once for all right sides: rows are eliminated in place, factors and exchanges kept.
    steps = []
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(rows[k + i, k]))
        rows[[k, best]] = rows[[best, k]]
        rows[k, k] = rows[k, k] or 1
        factors = [(x << bits) // rows[k, k] for x in rows[k + 1 :, k]]
        for i, f in enumerate(factors, k + 1):
            rows[i, k:] -= (f * rows[k, k:]) >> bits
        steps.append((best, np.array(factors, object)))

    def solved(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        for k, (best, factors) in enumerate(steps):
            v[k], v[best] = v[best], v[k]
            if k + 1 < d:
                v[k + 1 :] -= (factors * v[k]) >> bits
        for k in range(d - 1, -1, -1):
            rest = int((rows[k, k + 1 :] * v[k + 1 :]).sum()) >> bits if k + 1 < d else 0
            v[k] = ((v[k] - rest) << bits) // rows[k, k]
        return v

    def unit(v: np.ndarray) -> np.ndarray:
        # Large entries first lose the digits that no double will show.
        spare = max(0, max(abs(x) for x in v).bit_length() - 2 * bits)
        v = np.array([x >> spare for x in v], object)
        size = isqrt(int((v * v).sum()))
        return np.array([(x << bits) // size for x in v], object)

    draw = np.random.default_rng(root.many)
    found = [np.array([int(x) << (bits - 30) for x in draw.integers(1, 1 << 30, d)], object) for _ in range(root.many)]
    for _ in range(ITERATIONS):
        base: list[np.ndarray] = []
        for v in map(solved, found):
            v = unit(v)
            for _ in range(2):
                for b in base:
                    v = v - ((int((v * b).sum()) >> bits) * b >> bits)
                v = unit(v)
            base.append(v)
        found = base
    out = []
    for v in found:
        lead = max(v, key=abs)
        out.append([(x if lead > 0 else -x) / one for x in v.tolist()])
    return out
