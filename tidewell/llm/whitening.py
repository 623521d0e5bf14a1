"""Embedding whitening by MLlib's computeSVD on centred, distributed rows.

1. Numbers.  A row with a null vector, or with a null or non-finite entry, is left out.  Every other
   entry c becomes the whole number floor(256 * c), so what follows starts from exact values.
2. Fit.  Each distinct vector counts once.  Sums over dimensions and the exact deviations
   (sum over dimensions of (n * x - S)^2) are added as whole numbers; the total variance is the sum of the
   deviations over n^3 and owes nothing to the decomposition.
3. Components.  ``RowMatrix.computeSVD`` runs on the rows x - S/n.  A singular value s of the rows is
   rescaled by the divisor n: the covariance has the eigenvalue s^2 / n.  The sign of a component makes its
   entry of largest size positive.
4. Projection.  Rows meet the components in Arrow batches; the covariance of the whitened fit list is
   added up the same way and compared with the identity.

Only what grows with the dimension reaches the driver: sums, the d x d products inside computeSVD, and the
components.  Directions without variance (singular values below FLAT of the largest) have no whitened
value and are left out, so fewer than four components, or none for fewer than two distinct vectors, are
possible.

Edge cases: an empty table, and one without a usable row, gives an empty result; repeated rows, and rows
that repeat a vec_id, each get their rows; a null vec_id is carried through; equal eigenvalues come in the
solver's order, the same for all rows; where vectors differ in length, the shorter ones count as followed
by zeros (an empty vector is all zeros); a deviation beyond 64 bits is null; texts play no part, and other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, ship_package, stored

SCALE, COMPONENTS, FLAT = 256, 4, 1e-7
#: Up to this dimension all singular values are asked for, which makes computeSVD decompose in full.
FULL = 4096
#: Sums are added in two parts of so many low bits and the rest, so that they cannot overflow.
_LOW = 24
_MOST = 1 << 63


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its length, sums, components (rows), eigenvalues and total variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    variance: float


def whole_vectors(rows: DataFrame, vector: str = "embedding", name: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """vec_id, x (array<long>) of the usable rows, all of one length."""
    v = F.col(vector).cast("array<double>")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    kept = rows.select(F.col(name).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & F.forall("v", fine))
    whole = kept.select("vec_id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))
    size = whole.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if size["least"] == size["most"]:
        return whole
    return whole.select("vec_id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(size["most"]) - F.size("x"))).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in 64 bits where that holds the squares' sum, else in Python's integers."""
    most = n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < _MOST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(parts: np.ndarray) -> list[int]:
    return [int(d) for d in (parts * parts).sum(axis=1)]


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The length of the fit list and the exact sum of every dimension."""
    parts = fit.select(F.posexplode("x").alias("i", "c"))
    found = parts.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("c", _LOW)).alias("high"), F.sum(F.col("c").bitwiseAND(F.lit((1 << _LOW) - 1))).alias("low")).collect()  # one row a dimension
    sums = [0] * dims
    for r in found:
        sums[r["i"]] = (r["high"] << _LOW) + r["low"]
    return found[0]["n"], sums


def _total(fit: DataFrame, n: int, sums: list[int]) -> int:
    """The sum of the exact deviations of the fit list."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(sum(deviations(centred(_matrix(b.column("x"), len(sums)), n, sums))) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([str(total)])], ["total"])

    return sum(int(r[0]) for r in fit.select("x").mapInArrow(add, "total string").collect())  # one row a task


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (x array<long>), None if they have no variance."""
    first = fit.select(F.size("x").alias("d")).first()
    if first is None or not first["d"]:
        return None
    n, sums = _sums(fit, first["d"])
    total = _total(fit, n, sums)
    if not total:
        return None
    mean = F.array(*(F.lit(s / n) for s in sums))
    rows = fit.select(array_to_vector(F.zip_with(F.col("x").cast("array<double>"), mean, lambda a, b: a - b)).alias("v"))
    matrix = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"), n, len(sums))
    asked = len(sums) if len(sums) <= FULL else components
    found = matrix.computeSVD(asked, computeU=False, rCond=FLAT)
    values = found.s.toArray()[:components]
    vectors = found.V.toArray()[:, : len(values)].T
    biggest = vectors[np.arange(len(values)), np.abs(vectors).argmax(axis=1)]
    return Whitening(n, sums, vectors * np.sign(biggest)[:, None], values * values / n, total / n**3)


def _projected(parts: np.ndarray, w: Whitening) -> np.ndarray:
    """Whitened coordinates of rows n * x - S."""
    return (parts.astype(np.float64) / w.n) @ w.components.T / np.sqrt(w.eigenvalues)


def _identity_error(fit: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(w.eigenvalues)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            y = _projected(centred(_matrix(b.column("x"), len(w.sums)), w.n, w.sums), w)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["total"])

    cells = fit.select("x").mapInArrow(add, "total array<double>").select(F.posexplode("total").alias("i", "c"))
    sums = {r["i"]: r["s"] for r in cells.groupBy("i").agg(F.sum("c").alias("s")).collect()}  # k * k rows
    return max(abs(sums[i] / w.n - (i // k == i % k)) for i in range(k * k))


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", name: str = "vec_id") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable row and component."""
    spark = rows.sparkSession
    ship_package(spark)
    x = whole_vectors(rows, vector, name)
    fit = stored(x.select("x").distinct(), "fit")
    w = fit_whitening(fit, components)
    error = _identity_error(fit, w) if w else 0.0
    discard(fit)
    if not w:
        return spark.createDataFrame([], _OUT)
    k, share = len(w.eigenvalues), w.eigenvalues / w.variance

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = centred(_matrix(b.column("x"), len(w.sums)), w.n, w.sums)
            far = [d if d < _MOST else None for d in deviations(parts)]
            m = b.num_rows
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), pa.array(far, pa.int64()).take(each),
                pa.array(_projected(parts, w).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(project, _OUT)
