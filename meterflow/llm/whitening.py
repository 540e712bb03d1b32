"""Whitening of vectors: eigenvectors of their covariance in float32, refined to double precision.

The covariance is summed by Spark from integers, so it is exact and does not depend on
the order of tasks. Its float32 eigenvectors are corrected by Ogita-Aishima steps, which
are matrix multiplications in extended precision; eigenvalues that a step can't tell
apart yet are settled by solving the small problem of their subspace.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import packed, with_row, written
from meterflow.llm.vectors import as_vector, common_length, is_finite, matrix

COMPONENTS = 8
# An entry c counts as floor(SCALE * c) + SHIFT, a whole number.
SCALE, SHIFT = 1024, 100_000
# Whole numbers beyond this count as this, so that sums of their products fit 38 digits.
LARGEST = 1 << 40
# Sums of whole numbers in doubles are exact up to here.
EXACT = 1 << 53
STEPS = 40


def whole_numbers(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    limit = float(LARGEST - shift)
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(limit)), F.lit(-limit))) + shift)


# --------------------------------------------------------------------------
# eigenvectors


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more values, neighbours no further apart than ``gap``."""
    order = np.argsort(values, kind="stable")
    cuts = np.nonzero(np.diff(values[order]) > gap)[0] + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _off_diagonal(m: np.ndarray) -> np.ndarray:
    return m - np.diag(np.diag(m))


def refined_eigenvectors(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, to double precision.

    Each vector's largest entry is positive. Equal eigenvalues get some orthonormal
    basis of their space. A matrix of zeros gives zeros and unit axes.
    """
    size = len(covariance)
    scale = float(np.abs(covariance).max(initial=0.0))
    if scale == 0:
        return np.zeros(size), np.eye(size)
    a = covariance.astype(np.longdouble) / np.longdouble(scale)
    _, first = np.linalg.eigh(np.asarray(covariance / scale, dtype=np.float32))
    x = first.astype(np.longdouble)
    one = np.eye(size, dtype=np.longdouble)
    least = np.finfo(np.longdouble).eps * size
    norm = np.sqrt((a * a).sum())
    before = np.inf
    for _ in range(STEPS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        # Equal halves: what a small gap makes of their rounding must not turn the basis askew.
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = np.sqrt((_off_diagonal(s) ** 2).sum()) + norm * np.sqrt((r * r).sum())
        if off <= least or off >= before / 2 and off <= 64 * least:
            break
        before = off
        gap = 2 * off
        apart = values[None, :] - values[:, None]
        clear = np.abs(apart) > gap
        step = np.where(clear, (s + values[None, :] * r) / np.where(clear, apart, 1), r / 2)
        x = x + x @ step
        for run in _clusters(values, gap):
            own = x[:, run]
            # Measured from their mean, the values of a cluster keep the digits that tell them apart.
            inner = own.T @ (a @ own) - values[run].mean() * (own.T @ own)
            inner = (inner + inner.T) / 2
            width = np.abs(inner).max()
            if width > 0:
                _, turn = np.linalg.eigh(np.asarray(inner / width, dtype=np.float64))
                x[:, run] = own @ turn.astype(np.longdouble)
    # The last steps may leave lengths off by what extended precision can't show.
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, a @ x) * np.longdouble(scale)
    order = np.argsort(-values, kind="stable")
    vectors, values = x[:, order].astype(np.float64), values[order].astype(np.float64)
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(size)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


# --------------------------------------------------------------------------
# exact sums


def _int_rows(values: np.ndarray) -> pa.Array:
    return pa.array([[int(v) for v in row] for row in values], pa.list_(pa.decimal128(38, 0)))


def _sums(rows: DataFrame, length: int) -> tuple[int, list[int]]:
    """Rows and the sum of every dimension: one row of partial sums per task, added up by Spark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(length, dtype=object)
        for batch in batches:
            x = matrix(batch.column("x"), length)
            n += len(x)
            # Whole numbers of 2^40 at most: a batch can't overflow.
            total = total + x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array([n]), _int_rows(total[None, :])], ["n", "sums"])

    partial = rows.select("x").mapInArrow(run, "n long, sums array<decimal(38,0)>")
    parts = partial.select("n", F.posexplode("sums").alias("i", "total"))
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    sums = [0] * length
    for r in found:
        sums[r["i"]] = int(r["total"])
    return (found[0]["n"] if found else 0), sums


def _whole_products(d: np.ndarray) -> np.ndarray:
    """d^T d of whole numbers, exact, as whole numbers of any size."""
    length = d.shape[1]
    most = int(np.abs(d).max(initial=0))
    total = np.zeros((length, length), dtype=object)
    if most * most >= EXACT:
        # Split each number in two, so that the products of the halves are exact.
        high = d >> 20
        low = d - (high << 20)
        for left, right, shift in ((high, high, 40), (high, low, 20), (low, high, 20), (low, low, 0)):
            total = total + (_float_products(left, right) * (1 << shift))
        return total
    return _float_products(d, d)


def _float_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0))
    rows = max(1, EXACT // max(1, most) - 1)
    total = np.zeros((left.shape[1], right.shape[1]), dtype=object)
    for at in range(0, len(left), rows):
        a, b = left[at : at + rows].astype(np.float64), right[at : at + rows].astype(np.float64)
        total = total + (a.T @ b).astype(np.int64).astype(object)
    return total


def _products(rows: DataFrame, length: int, centre: list[int]) -> list[list[int]]:
    """Sums of products of all pairs of dimensions, each number taken from ``centre``."""
    around = np.array(centre, dtype=np.int64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length), dtype=object)
        for batch in batches:
            total = total + _whole_products(matrix(batch.column("x"), length) - around)
        yield pa.RecordBatch.from_arrays([pa.array(range(length), pa.int32()), _int_rows(total)], ["i", "products"])

    partial = rows.select("x").mapInArrow(run, "i int, products array<decimal(38,0)>")
    cells = partial.select("i", F.posexplode("products").alias("j", "total")).filter("j >= i")
    products = [[0] * length for _ in range(length)]
    for r in cells.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        products[r["i"]][r["j"]] = products[r["j"]][r["i"]] = int(r["total"])
    return products


@dataclass(frozen=True)
class Fit:
    """What whitening needs of all rows: n, sums and the components that hold variance."""

    n: int
    sums: tuple[int, ...]
    centre: tuple[int, ...]
    values: tuple[float, ...]
    vectors: np.ndarray
    trace: float


def fit(rows: DataFrame, length: int, components: int = COMPONENTS) -> Fit:
    """Fit to a column ``x`` of whole numbers; only sums by dimension reach the driver."""
    n, sums = _sums(rows, length)
    centre = [(2 * s + n) // (2 * n) for s in sums]  # the mean, rounded
    products = _products(rows, length, centre)
    rest = [s - n * c for s, c in zip(sums, centre)]
    # Whole numbers divided last: every entry is the double nearest to its exact value.
    covariance = np.array(
        [[(n * products[i][j] - rest[i] * rest[j]) / (n * n) for j in range(length)] for i in range(length)]
    )
    values, vectors = refined_eigenvectors(covariance)
    trace = float(np.trace(covariance))
    held = min(components, length)
    # Below rounding error of the trace there is no variance to scale by.
    values = [float(v) if v > length * np.finfo(float).eps * trace else 0.0 for v in values[:held]]
    return Fit(n, tuple(sums), tuple(centre), tuple(values), vectors[:, :held], trace)


def _exact_deviation(d: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Per row the sum of squares of n * d - rest; null where it passes a long."""
    most = n * int(np.abs(d).max(initial=0)) + max(map(abs, rest), default=0)
    kind = np.int64 if most * most * max(1, d.shape[1]) < 1 << 63 else object
    off = d.astype(kind) * n - np.array(rest, dtype=kind)
    return [int(v) if v < 1 << 63 else None for v in (off * off).sum(axis=1)]


def whiten(
    vectors: DataFrame, column: str = "embedding", keep: list[str] | None = None, components: int = COMPONENTS
) -> DataFrame:
    """``row`` (the kept columns, all by default), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries count as whole numbers floor(1024 c) + 100000. ``n`` rows remain, S are their sums:
    ``deviation`` is the sum over dimensions of (n x - S)^2 (null where it passes a long),
    ``whitened`` a row's coordinates along the first ``components`` eigenvectors of the
    covariance (divisor n), each over the root of its eigenvalue, ``explained`` the shares of
    the eigenvalues, ``identity_error`` how far the covariance of ``whitened`` is from the
    identity at most.

    Rows whose vector is null, empty, holds null or non-finite entries, or has not the length
    that most remaining vectors have, are left out. Entries beyond 2^40 after scaling count as 2^40.
    A component without variance has null coordinates, as when all rows are equal (then
    ``explained`` is null and ``identity_error`` 0). Repeated rows count each and stay.
    An empty table gives no rows.
    """
    found = vectors.select(packed(vectors, keep), as_vector(column).alias("vector")).filter(is_finite(F.col("vector")))
    length = common_length(found, "vector")
    rows = found.filter(F.size("vector") == length).select("row", whole_numbers(F.col("vector")).alias("x"))
    schema = with_row(rows, deviation="long", whitened=T.ArrayType(T.DoubleType()))
    if length == 0:
        empty = rows.select("row", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("deviation"))
        none = F.lit(None).cast("array<double>")
        return empty.select(
            "*", none.alias("whitened"), none.alias("explained"), F.lit(None).cast("double").alias("identity_error")
        )
    fitted = fit(rows, length, components)
    n, held = fitted.n, len(fitted.values)
    rest = [s - n * c for s, c in zip(fitted.sums, fitted.centre)]
    around, offset = np.array(fitted.centre, dtype=np.int64), np.array([s / n for s in rest])
    roots = np.array([v**0.5 if v else np.nan for v in fitted.values])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = matrix(batch.column("x"), length) - around
            placed = ((d - offset) @ fitted.vectors / roots).ravel()
            lists = pa.ListArray.from_arrays(
                pa.array(range(0, len(d) * held + 1, held), pa.int32()), pa.array(placed, from_pandas=True)
            )
            deviation = pa.array(_exact_deviation(d, n, rest), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), deviation, lists], ["row", "deviation", "whitened"])

    placed = written(rows.mapInArrow(run, schema), "whitened")
    explained = [F.lit(v / fitted.trace if fitted.trace else None).cast("double") for v in fitted.values]
    return placed.select(
        "row",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*explained).alias("explained"),
        F.lit(_identity_error(placed, [i for i, v in enumerate(fitted.values) if v])).alias("identity_error"),
    )


def _identity_error(placed: DataFrame, held: list[int]) -> float:
    """Largest entry of the covariance of the written coordinates minus the identity, centred first."""
    if not held:
        return 0.0
    at = {i: F.element_at("whitened", i + 1) for i in held}
    means = placed.agg(*[F.avg(at[i]) for i in held]).first()
    off = {i: at[i] - m for i, m in zip(held, means)}
    pairs = [(i, j) for i in held for j in held if i <= j]
    found = placed.agg(*[F.avg(off[i] * off[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))
