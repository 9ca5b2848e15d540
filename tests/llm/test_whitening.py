import math
import random
from fractions import Fraction

import numpy as np
import pytest
from helpers import SF
from pyspark.sql import functions as F

from obsledger.llm import charpoly, on_corpus
from obsledger.llm.whitening import exact_products, whiten

NAMES = "vec_id long, embedding array<float>, whitened string, n int"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "old", 0) for r in rows], NAMES)


def integers(v):
    if not v or any(c is None or not math.isfinite(c) for c in v):
        return None
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def check(rows, got, components=16):
    """Against whole-number sums and numpy's eigenvectors."""
    ints = [(i, integers(v)) for i, v in rows]
    ints = [(i, x) for i, x in ints if x is not None]
    fit = sorted({x for _, x in ints})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    away = lambda x: [n * a - s for a, s in zip(x, sums, strict=True)]
    centred = np.array([[float(Fraction(a, n)) for a in away(x)] for x in fit])
    cov = centred.T @ centred / n
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    assert sorted(((r.vec_id, r.deviation) for r in got), key=repr) == sorted(
        ((i, sum(a * a for a in away(x))) for i, x in ints), key=repr
    )
    assert all(r.n == n and len(r.whitened) == len(r.explained) == k for r in got)
    if not k:
        return
    explained = np.array(got[0].explained)
    assert explained == pytest.approx(values[:k] / values.sum(), rel=1e-9)
    assert got[0].identity_error < 1e-9
    # Components from the whitened vectors themselves: the least-squares map from centred vectors.
    x_of = {}
    for i, x in ints:
        x_of.setdefault(i, []).append(x)
    single = [(x_of[r.vec_id][0], r.whitened) for r in got if len(x_of[r.vec_id]) == 1]
    c = np.array([[float(Fraction(a, n)) for a in away(x)] for x, _ in single])
    w = np.array([w for _, w in single])
    vectors, *_ = np.linalg.lstsq(c, w, rcond=None)
    units = vectors * np.sqrt(values[:k])
    assert np.abs(cov @ units - units * values[:k]).max() < 1e-6 * values[0]
    assert np.abs(c @ units / np.sqrt(values[:k]) - w).max() < 1e-7


def random_rows(n, d, seed):
    r = random.Random(seed)
    rows = [(i, [r.gauss(0, 1 + j / d) for j in range(d)]) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(n // 2)]


def test_like_numpy(spark):
    rows = random_rows(120, 8, 1)
    odd = [(900, None), (901, []), (902, [1.0, None] * 4), (903, [float("nan")] * 8), (904, [float("inf")] * 8)]
    odd += [(None, rows[3][1]), (5, rows[5][1]), (5, rows[5][1])]
    check(rows + odd, whiten(vectors(spark, rows + odd)).collect())


def test_equal_variances_and_few_components(spark):
    # A cube's corners vary alike in all directions.
    rows = [(i, [(2.0 if i >> b & 1 else -2.0) for b in range(4)]) for i in range(16)]
    got = whiten(vectors(spark, rows)).collect()
    check(rows, got)
    w = np.array([r.whitened for r in got])
    assert np.abs(w.T @ w / 16 - np.eye(4)).max() < 1e-12
    assert all(len(r.whitened) == 2 for r in whiten(vectors(spark, rows), components=2).collect())


def test_large_and_lacking_entries(spark):
    rows = [(i, [1e12 * math.sin(i), 3e38 * (i % 2), float(i % 3)]) for i in range(9)]
    got = whiten(vectors(spark, rows)).collect()
    assert len(got) == 9 and all(r.deviation is None and len(r.whitened) == 3 for r in got)
    assert got[0].identity_error < 1e-6


def test_rank_one_single_and_empty(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    check(line, whiten(vectors(spark, line)).collect())
    one = whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in one] == [(1, 0, [], None)] * 2
    assert whiten(vectors(spark, [])).count() == 0
    assert whiten(vectors(spark, [(1, None)])).count() == 0


def test_other_lengths_go(spark):
    rows = [(i, [float(i), i * i / 3]) for i in range(6)]
    got = whiten(vectors(spark, rows + [(70, [1.0]), (71, [1.0]), (72, [1.0, 2.0, 3.0])])).collect()
    check(rows, got)


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = on_corpus.QUERIES["op11_whitening"](spark, SF)
    grouped = got.groupBy("vec_id", "n", "deviation", "identity_error").agg(
        F.array_sort(F.collect_list(F.struct("component", "whitened", "explained"))).alias("c")
    )
    wide = grouped.selectExpr("vec_id", "n", "deviation", "identity_error", "c.whitened", "c.explained").collect()
    check(rows, wide)


def test_polynomial_roots_and_primes():
    r = random.Random(4)
    for d in (1, 2, 3, 7):
        y = [[r.randrange(-9, 10) for _ in range(d)] for _ in range(d + 2)]
        m = [[sum(row[i] * row[j] for row in y) for j in range(d)] for i in range(d)]
        primes = charpoly.primes_beyond(2 * charpoly.coefficient_bound(m))
        residues = charpoly.modular_polynomials(m, primes).tolist()
        p = charpoly.remaindered(dict(zip(primes, residues, strict=True)))
        assert p == [int(c) for c in np.rint(np.poly(np.array(m, float)))] if d < 4 else len(p) == d + 1
        for k, value in enumerate(np.linalg.eigvalsh(np.array(m, float))[::-1], 1):
            root = charpoly.root_number(p, k)
            assert (root.low + root.high) / 2 ** (root.shift + 1) == pytest.approx(value, rel=1e-6)
    assert charpoly.primes_beyond(1 << 40)[:2] == [2147483647, 2147483629]


def test_a_column_without_pivot():
    m = [[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]]
    primes = charpoly.primes_beyond(2 * charpoly.coefficient_bound(m))
    p = charpoly.remaindered(dict(zip(primes, charpoly.modular_polynomials(m, primes).tolist(), strict=True)))
    assert p == [1, -10, 36, -54, 27]  # (t - 3)^3 (t - 1)
    assert charpoly.root_number(p, 2).many == 3
    basis = np.array(charpoly.null_vectors(m, charpoly.root_number(p, 1)))
    assert np.abs(basis @ basis.T - np.eye(3)).max() < 1e-15
    assert np.abs(basis @ np.array(m) - 3 * basis).max() < 1e-14


def test_exact_products():
    y = np.random.default_rng(0).integers(-(1 << 50), 1 << 50, (70, 3))
    whole = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for j in range(3)] for i in range(3)]
    assert exact_products(y).tolist() == whole
