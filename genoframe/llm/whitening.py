"""Operator 11: principal components of embeddings, and rows whitened by them.

1. Each entry becomes a whole number; each distinct vector of such numbers is once in the fit list, which is written to the shared folder.
2. One pass over the list sums its vectors, a second one centres them at the rounded mean and sums their products. All of these are
   whole numbers and exact; the part that rounding left of the mean is taken off, also exactly, so that no digits of the covariance are lost.
3. The driver holds one ``d x d`` matrix (``d``: entries of a vector): Householder reflections make it tridiagonal, Sturm counts bisect the leading eigenvalues,
   inverse iteration gives their vectors, which within clusters are made orthogonal again.
4. ``d x 16`` numbers go to all tasks, which project. A third pass over the fit list measures how far the covariance of the whitened list is from the identity.

Defined results: rows are dropped whose vector is null, empty, has null or non-finite entries or entries of ``LIMIT`` or more in magnitude (their whole numbers
would not fit), or has another number of entries than most vectors have. Repeated rows and ids and null ids have rows of their own. Components whose eigenvalue is not
above ``RANK`` of the largest are rounding only and left out, so that a single distinct vector, or none, gives an empty result. Among equal
eigenvalues the components are some orthogonal ones, the same for all rows. ``deviation`` is null where it is beyond a long (with 64 entries of usual size, from some 50 million distinct vectors).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm.common import settle
from genoframe.llm.vectors import matrix, sound, usual_length

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
LIMIT = float(1 << 34)
RANK = 1e-11
#: Whole numbers below it have products that sum exactly in doubles, over so many rows.
SMALL, ROWS = 1 << 18, 1 << 16


# --- the symmetric eigenproblem


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the reflections that bring ``a`` to this form."""
    a, size, mirrors = a.copy(), len(a), []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length > 0:
            v[0] += np.copysign(length, v[0])
            v /= np.linalg.norm(v)
            inner = a[k + 1 :, k + 1 :]
            w = inner @ v
            w -= (v @ w) * v
            inner -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = a[k, k + 1] = a[k + 1, k] - 2 * v[0] * (v @ a[k + 1 :, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each number the count of eigenvalues below it: the negative pivots of the shifted matrix (a Sturm sequence)."""
    tiny = np.finfo(float).tiny
    least = np.finfo(float).eps * max(np.abs(off).max(initial=0.0), tiny / np.finfo(float).eps)
    pivot, count = np.ones(len(at)), np.zeros(len(at), np.int64)
    for k in range(len(diagonal)):
        pivot = diagonal[k] - at - (off[k - 1] ** 2 / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    size, around = len(diagonal), np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    places = size - 1 - np.arange(min(most, size))
    lo, hi = np.full(len(places), (diagonal - around).min()), np.full(len(places), (diagonal + around).max())
    width = np.finfo(float).eps * max(np.abs(lo).max(initial=0.0), np.abs(hi).max(initial=0.0))
    lo, hi = lo - width, hi + width
    while True:
        middle = lo + (hi - lo) / 2
        if np.all((middle <= lo) | (middle >= hi)):
            return middle
        above = counts_below(diagonal, off, middle) > places
        lo, hi = np.where(above, lo, middle), np.where(above, middle, hi)


def _solve(diagonal: np.ndarray, off: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Solves a tridiagonal system by elimination with row exchanges; pivots that vanish become ``least``."""
    size = len(diagonal)
    a, b, c, x = diagonal.tolist(), [*off.tolist(), 0.0], [0.0] * size, right.tolist()
    below = off.tolist()
    for k in range(size - 1):
        if abs(below[k]) > abs(a[k]):
            # the next row comes first
            a[k], b[k], c[k], a[k + 1], b[k + 1], low = below[k], a[k + 1], b[k + 1], b[k], c[k], a[k]
            x[k], x[k + 1] = x[k + 1], x[k]
        else:
            low = below[k]
        a[k] = a[k] if abs(a[k]) > least else least
        factor = low / a[k]
        a[k + 1] -= factor * b[k]
        b[k + 1] -= factor * c[k]
        x[k + 1] -= factor * x[k]
    a[-1] = a[-1] if abs(a[-1]) > least else least
    for k in range(size - 1, -1, -1):
        x[k] = (x[k] - (b[k] * x[k + 1] if k + 1 < size else 0.0) - (c[k] * x[k + 2] if k + 2 < size else 0.0)) / a[k]
    return np.array(x)


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (columns) by inverse iteration; those of values close together are made orthogonal in each step."""
    size, eps = len(diagonal), np.finfo(float).eps
    norm = max((np.abs(diagonal) + np.abs(np.append(off, 0)) + np.abs(np.append(0, off))).max(initial=0.0), np.finfo(float).tiny / eps)
    random, out, cluster, shift = np.random.default_rng(11), np.empty((size, len(values))), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            cluster = j
        # equal values are solved a little apart
        shift = min(value, shift - 10 * eps * norm) if j > cluster else value
        x = random.standard_normal(size)
        for _ in range(5):
            x = _solve(diagonal - shift, off, x / np.linalg.norm(x), eps * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                near = out[:, cluster:j]
                x -= near @ (near.T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns, the largest entry of each positive."""
    scale = np.abs(a).max(initial=0.0)
    if scale == 0:
        return np.empty(0), np.empty((len(a), 0))
    diagonal, off, mirrors = tridiagonal(a / scale)
    values = leading_values(diagonal, off, most)
    values = values[values > RANK * values[0]]
    vectors = eigenvectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values * scale, vectors


# --- sums over the fit list


class Moments(NamedTuple):
    """n vectors, their mean as ``centre + rest / n`` (whole numbers) and their covariance."""

    n: int
    centre: np.ndarray
    rest: list[int]
    covariance: np.ndarray


def _summed(parts: DataFrame) -> dict[int, int]:
    return {r["at"]: int(r["s"]) for r in parts.groupBy("at").agg(F.sum("value").alias("s")).collect()}


_PART = pa.schema([("at", pa.int64()), ("value", pa.decimal128(38, 0))])
_PART_DDL = "at long, value decimal(38,0)"


def _part(values: list[int]) -> pa.RecordBatch:
    import decimal

    return pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int64()), pa.array([decimal.Decimal(v) for v in values], pa.decimal128(38, 0))], schema=_PART)


def products(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns of a whole-number array, as Python numbers."""
    total = np.zeros((y.shape[1],) * 2, object)
    small = (np.abs(y) < SMALL).all(axis=1)
    for lo in range(0, len(y), ROWS):
        part = y[lo : lo + ROWS][small[lo : lo + ROWS]].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    large = y[~small].astype(object)
    return total + large.T @ large if len(large) else total


def moments(fit: DataFrame, width: int) -> Moments:
    """Exact sums over the column ``x`` (whole numbers less ``SHIFT``) of the fit list; from each task come ``width`` squared numbers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (width + 1)
        for batch in batches:
            x = matrix(batch.column(0), width)
            total = [a + b for a, b in zip(total, [*x.sum(axis=0).tolist(), len(x)], strict=True)]
        yield _part(total)

    found = _summed(fit.mapInArrow(sums, _PART_DDL))
    n = found.get(width, 0)
    if not n:
        return Moments(0, np.zeros(width, np.int64), [0] * width, np.zeros((width, width)))
    centre = np.array([(2 * found[k] + n) // (2 * n) for k in range(width)], np.int64)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total += products(matrix(batch.column(0), width) - centre)
        yield _part(total.ravel().tolist())

    rest = [found[k] - n * int(centre[k]) for k in range(width)]
    around = _summed(fit.mapInArrow(centred, _PART_DDL))
    covariance = [[(n * around[i * width + j] - rest[i] * rest[j]) / (n * n) for j in range(width)] for i in range(width)]
    return Moments(n, centre, rest, np.array(covariance))


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """The sum of (n * y - rest) squared of each row, exactly; None where it is beyond a long."""
    fits = np.abs(y).max(axis=1, initial=0).astype(float) * n + max(map(abs, rest), default=0) < 2.0**62
    t = np.where(fits[:, None], y, 0) * n - np.array(rest, np.int64)
    fits &= (t.astype(float) ** 2).sum(axis=1) < 2.0**62
    out = np.where(fits, (np.where(fits[:, None], t, 0) ** 2).sum(axis=1), 0).tolist()
    for k in np.flatnonzero(~fits).tolist():
        exact = sum((n * v - r) ** 2 for v, r in zip(y[k].tolist(), rest, strict=True))
        out[k] = exact if exact < 1 << 63 else None
    return out


_OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64())])


def whiten(rows: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, float]:
    """(vec_id, component, n, deviation, whitened, explained) of the rows (vec_id, embedding), and the identity error of the whitened fit list."""
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(sound(LIMIT))
    width = usual_length(kept)
    whole = F.expr(f"transform(embedding, c -> floor({SCALE} * double(c)))").alias("x")
    numbered = kept.where(F.size("embedding") == width).select("vec_id", whole)
    fit = settle(numbered.select("x").distinct(), "whitening-fit")
    found = moments(fit, width)
    values, vectors = leading(found.covariance, components)
    n, centre, rest, k = found.n, found.centre, found.rest, len(values)
    project, left = vectors / np.sqrt(values), np.array(rest, float) / max(n, 1)
    explained = (values / np.trace(found.covariance)).tolist() if k else []

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            z = (matrix(batch.column(0), width) - centre - left) @ project
            z = np.column_stack((z, np.ones(len(z))))
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int64()), pa.array(total.ravel())], names=["at", "value"])

    error = 0.0
    if k:
        sums = np.zeros((k + 1) * (k + 1))
        for r in fit.mapInArrow(spread, "at long, value double").groupBy("at").agg(F.sum("value").alias("s")).collect():
            sums[r["at"]] = r["s"]
        second = sums.reshape(k + 1, k + 1) / n
        error = float(np.abs(second[:k, :k] - np.outer(second[:k, k], second[:k, k]) - np.eye(k)).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = matrix(batch.column(1), width) - centre
            z = (y - left) @ project
            each = np.repeat(np.arange(len(y)), k)
            columns = [batch.column(0).take(pa.array(each)), np.tile(np.arange(1, k + 1), len(y)), np.full(len(each), n), pa.array(deviations(y, n, rest), pa.int64()).take(pa.array(each)), z.ravel(), np.tile(explained, len(y))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)

    return numbered.mapInArrow(projected, "vec_id long, component int, n long, deviation long, whitened double, explained double"), error


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, error = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return out.withColumn("identity_error", F.lit(error))
