"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Vectors become integers; the scatter of the distinct ones is summed in Spark without rounding, about
their rounded means. Its characteristic polynomial is found in Spark tasks modulo primes, its largest
roots and their null vectors in one task each (see ``charpoly``).
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.llm.charpoly import (
    coefficient_bound,
    modular_polynomials,
    null_vectors,
    primes_beyond,
    remaindered,
    root_number,
)
from obsledger.llm.tables import Scratch, add_columns, slices

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 50)
"""Scaled entries beyond it count as it."""
LIMB = 20
"""Bits of the pieces that a matrix product takes; its sums over ``CHUNK`` rows are exact in doubles."""
CHUNK = 4096
PRIMES_A_TASK = 8

SUMS = "i int, j int, s decimal(38,0)"
PRODUCTS = "i int, j int, s double"
ADDED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
        T.StructField("explained", T.ArrayType(T.DoubleType())),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


class Whitening(NamedTuple):
    """n distinct vectors of integers with mean ``centre + rest / n``; unit ``components`` (rows) by falling
    ``variances``, each ``explained`` as a share of all variance."""

    n: int
    centre: list[int]
    rest: list[int]
    components: list[list[float]]
    variances: list[float]
    explained: list[float]
    identity_error: float | None = None


def integers_of(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The vector as integers; null if it is null or empty or holds an entry that is null or not finite."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    held = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double") * scale))
    whole = F.transform(vector, lambda c: F.floor(held(c)) + F.lit(offset).cast("bigint"))
    return F.when((F.size(vector) > 0) & ~F.exists(vector, odd), whole)


def _matrix(batch: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).flatten().to_numpy().reshape(-1, d)


def _rows(names: tuple[int, ...], values: list, kind: pa.DataType, fields: list[str]) -> pa.RecordBatch:
    i, j = (pa.array(np.asarray(x, np.int32)) for x in names)
    return pa.RecordBatch.from_arrays([i, j, pa.array(values, kind)], names=fields)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Pieces of at most LIMB bits with sign: y is their sum, the k-th shifted by k LIMB bits."""
    found, half = [], 1 << (LIMB - 1)
    while y.any() or not found:
        low = ((y + half) & ((1 << LIMB) - 1)) - half
        found.append(low.astype(np.float64))
        y = (y - low) >> LIMB
    return found


def exact_products(y: np.ndarray) -> np.ndarray:
    """y'y in whole numbers (Python integers), by products of pieces that doubles hold exactly."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    for at in range(0, len(y), CHUNK):
        limbs = _limbs(y[at : at + CHUNK])
        for a, left in enumerate(limbs):
            for b, right in enumerate(limbs):
                part = (left.T @ right).astype(np.int64).astype(object)
                total = total + part * (1 << LIMB * (a + b))
    return total


def _summed(fit: DataFrame, schema: str, kind: pa.DataType, d: int, zero, add, values) -> dict[tuple[int, int], object]:
    """Sums over all rows: each task adds its own into arrays, Spark adds those. One result for
    each place of the arrays, so what reaches the driver is bounded by the dimension."""
    fields = ["i", "j", "s"]

    def run(batches):
        total, any_rows = zero(), False
        for piece in slices(batches):
            total, any_rows = add(total, _matrix(piece, "x", d)), True
        if any_rows:
            yield from (_rows(names, list(v), kind, fields) for names, v in values(total))

    return {(r.i, r.j): r.s for r in fit.mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}


def _decimals(numbers) -> list[Decimal]:
    return [Decimal(int(x)) for x in numbers]


def vector_sums(fit: DataFrame, d: int) -> list[int]:
    add = lambda t, x: t + x.astype(object).sum(axis=0)
    values = lambda t: [((range(d), np.zeros(d)), _decimals(t))]
    found = _summed(fit, SUMS, pa.decimal128(38, 0), d, lambda: np.zeros(d, object), add, values)
    return [int(found[i, 0]) for i in range(d)]


def scatter(fit: DataFrame, centre: list[int], rest: list[int], n: int) -> list[list[int]]:
    """n^2 times the covariance (divisor n), a matrix of integers: vectors are centred at whole
    numbers before they are multiplied, and what the rounded centre leaves is taken off exactly."""
    d, middle = len(centre), np.array(centre, np.int64)
    upper = np.triu_indices(d)
    add = lambda t, x: t + exact_products(x - middle)
    values = lambda t: [(upper, _decimals(t[upper]))]
    found = _summed(fit, SUMS, pa.decimal128(38, 0), d, lambda: np.zeros((d, d), object), add, values)
    return [[n * int(found[min(i, j), max(i, j)]) - rest[i] * rest[j] for j in range(d)] for i in range(d)]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t - matrix), the highest power first: residues in tasks of a few primes each."""
    primes = primes_beyond(2 * coefficient_bound(matrix))

    def run(batches):
        for batch in batches:
            if mine := [primes[i] for i in batch.column(0).to_pylist()]:
                found = modular_polynomials(matrix, mine)
                rows = pa.array(found.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(mine, pa.int64()), rows], names=["p", "residues"])

    tasks = -(-len(primes) // PRIMES_A_TASK)
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "p bigint, residues array<bigint>")
    return remaindered({r.p: r.residues for r in found.collect()})


def principal_components(
    spark: SparkSession, matrix: list[list[int]], polynomial: list[int], components: int
) -> list[tuple[float, list[float]]]:
    """(root as a share of the trace, unit vector) of the largest roots that are positive, one task each."""
    trace = sum(row[i] for i, row in enumerate(matrix))

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root = root_number(polynomial, k)
                if root is not None:
                    share = (root.low + root.high) / (trace << (root.shift + 1))
                    # Equal roots: each task makes the same basis and takes its own vector.
                    vector = null_vectors(matrix, root)[k - 1 - root.above]
                    arrays = [pa.array([k], pa.int64()), pa.array([share]), pa.array([vector], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["k", "share", "vector"])

    most = min(components, len(matrix))
    found = spark.range(1, most + 1, 1, most).mapInArrow(run, "k bigint, share double, vector array<double>")
    return [(r.share, list(r.vector)) for r in sorted(found.collect(), key=lambda r: r.k)]


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    centred = (x - np.array(model.centre, np.int64)) - np.array(model.rest, float) / model.n
    vectors = np.array(model.components, float).reshape(-1, len(model.centre))
    return centred @ vectors.T / np.sqrt(model.variances)


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum of (n x - S)^2 of each row; null where 64 bits do not hold it."""
    n, y = model.n, x - np.array(model.centre, np.int64)
    largest = n * (int(np.abs(y).max(initial=0)) + 1)
    if largest * largest * y.shape[1] >= 1 << 63:
        y = y.astype(object)
    away = y * n - np.array(model.rest, y.dtype)
    return [v if v < 1 << 63 else None for v in map(int, (away * away).sum(axis=1))]


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, over the distinct vectors."""
    d, k = len(model.centre), len(model.components)
    zero = lambda: np.zeros((k + 1, k))

    def add(total, x):
        w = _projected(x, model)
        return total + np.vstack([w.sum(axis=0), w.T @ w])

    names = tuple(a.ravel() for a in np.indices((k + 1, k)))
    values = lambda t: [(names, t.ravel())]
    found = _summed(fit, PRODUCTS, pa.float64(), d, zero, add, values)
    sums = np.array([[found[i, j] for j in range(k)] for i in range(k + 1)]) / model.n
    return float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(k)).max())


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``fit``: distinct rows with ``x``, ``d`` integers each."""
    spark, n = fit.sparkSession, fit.count()
    sums = vector_sums(fit, d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    matrix = scatter(fit, centre, rest, n)
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return Whitening(n, centre, rest, [], [], [])
    found = principal_components(spark, matrix, characteristic_polynomial(spark, matrix), components)
    shares, vectors = [s for s, _ in found], [v for _, v in found]
    model = Whitening(n, centre, rest, vectors, [s * (trace / n**2) for s in shares], shares)
    return model._replace(identity_error=identity_error(fit, model))


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    vec_col: str = "embedding",
) -> DataFrame:
    """Usable rows with n, deviation, whitened, explained (arrays, by falling variance) and identity_error.

    An entry c is taken as the integer floor(scale c) + offset. The whitening is fitted on the distinct
    vectors of integers, n of them, each once however often it stands, and applied to all rows. ``deviation`` is
    the exact sum of (n x - S)^2 over the dimensions, S their sums; null where it takes more than 64 bits.

    Rows go whose vector is null or empty, holds an entry that is null or not finite, or has another
    length than most distinct vectors (of two equally frequent lengths the longer stays). Scaled entries beyond
    2^50 count as 2^50. Directions without variance are no components: equal vectors, or
    a single one, give empty arrays and a null error; fewer dimensions than ``components`` give fewer. Equal
    variances get orthogonal components. Repeated rows and rows without id stay as they are; columns
    named as above are replaced, others pass through.

    The driver holds the scatter and the polynomial: numbers of the dimension, never of rows. Work in
    the tasks grows with its fourth power; meant for up to about a thousand dimensions.
    """
    scratch = Scratch(vectors.sparkSession, "whitening")
    held = vectors.withColumn("_x", integers_of(F.col(vec_col), scale, offset)).where("_x is not null")
    fit = scratch.keep(held.select(F.col("_x").alias("x")).distinct(), "fit")
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c"))
    usual = lengths.orderBy(F.desc("c"), F.desc("d")).limit(1).collect()
    d = usual[0].d if usual else 0
    model = fit_whitening(fit.where(F.size("x") == d), d, components) if d else Whitening(0, [], [], [], [], [])

    def make():
        def columns(batch: pa.RecordBatch) -> list:
            x, m = _matrix(batch, "_x", d), batch.num_rows
            lists = pa.list_(pa.float64())
            return [
                pa.array([model.n] * m, pa.int64()),
                pa.array(_deviations(x, model), pa.int64()),
                pa.array(_projected(x, model).tolist(), lists),
                pa.array([model.explained] * m, lists),
                pa.array([model.identity_error] * m, pa.float64()),
            ]

        return columns

    return add_columns(held.where(F.size("_x") == d), ADDED, make).drop("_x")
