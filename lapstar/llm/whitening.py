"""Embedding whitening by spectrum slicing.

Vectors are scaled to whole numbers, so that the sums of the fit list and of its products, taken around the rounded mean,
are exact whatever the order of the rows. They are reduced to one table of d * d sums on the executors; the
covariance is rounded once, at the end.

Its leading eigenvalues are found one by one. The signs of the pivots of ``V - s I = L D L'`` (Bunch and Kaufman's pivots
of one or two rows) tell how many eigenvalues lie above s, so bisection by such counts isolates the kth eigenvalue. Rayleigh
quotient iteration converges from there; should it leave the interval, bisection goes on. At the end the counts on
both sides of each value found certify its number. Eigenvalues that agree to rounding have no vectors of their own;
any orthonormal ones of their common space are taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstar.session import save

SCALE = 256
COMPONENTS = 4
ROUND = np.finfo(np.float64).eps
_PIVOT = (1 + 17**0.5) / 8
_LONG = 1 << 63
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole(vector: Column, scale: int = SCALE) -> Column:
    """Components as ``floor(scale * x)``, whole; null for a vector that is null or holds null, NaN or infinity."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    numbers = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & F.coalesce(fine, F.lit(False)), numbers)


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are greater than ``shift``: positive pivots of its LDL' form."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    while k < n:
        size = 1
        column = np.abs(a[k + 1 :, k])
        if len(column):
            r = k + 1 + int(column.argmax())
            most = float(column[r - k - 1])
            if most > 0 and abs(a[k, k]) < _PIVOT * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                greatest = float(row.max())
                if abs(a[k, k]) * greatest < _PIVOT * most * most:
                    size, to = (1, k) if abs(a[r, r]) >= _PIVOT * greatest else (2, k + 1)
                    if r != to:
                        a[[to, r]] = a[[r, to]]
                        a[:, [to, r]] = a[:, [r, to]]
        rest = slice(k + size, n)
        if size == 1:
            pivot = a[k, k]
            positive += pivot > 0
            if pivot != 0:
                a[rest, rest] -= np.outer(a[rest, k] / pivot, a[k, rest])
        else:
            positive += 1  # such a pair always has one positive and one negative eigenvalue
            a[rest, rest] -= a[rest, k : k + 2] @ np.linalg.solve(a[k : k + 2, k : k + 2], a[k : k + 2, rest])
        k += size
    return positive


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray, tiny: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        found = np.linalg.solve(shifted, vector)
    except np.linalg.LinAlgError:
        found = np.linalg.solve(shifted + tiny * np.eye(len(matrix)), vector)
    return found / np.linalg.norm(found)


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and their unit vectors as columns, each with its largest entry positive.

    Raises ``ArithmeticError`` if the counts do not certify what was found.
    """
    n = len(matrix)
    k = min(k, n)
    spread = np.abs(matrix).sum(1)
    bound = float(spread.max(initial=0))
    if bound == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    tiny = bound * ROUND
    margin = 8 * n * tiny  # rounding of a count's factorisation and of a Rayleigh quotient
    counts = {}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(matrix, shift)
        return counts[shift]

    values, vectors = np.zeros(k), np.zeros((n, k))
    high = bound + margin
    counts[high] = 0
    for number in range(k):
        # The least interval known so far with number + 1 eigenvalues above its lower end and at most number above the upper.
        low = max((s for s, c in counts.items() if c > number), default=-bound - margin)
        high = min(s for s, c in counts.items() if c <= number)

        def halve(low: float, high: float) -> tuple[float, float]:
            middle = low + (high - low) / 2
            return (middle, high) if count(middle) > number else (low, middle)

        while high - low > margin and not (count(low) == number + 1 and count(high) == number):
            low, high = halve(low, high)
        start = np.random.default_rng(number).normal(size=n)
        while True:
            # Earlier vectors are taken out again and again, as equal eigenvalues share their space.
            found, shift, least = start, low + (high - low) / 2, np.inf
            for step in range(12):
                last = found
                found = found - vectors[:, :number] @ (vectors[:, :number].T @ found)
                found = _solve(matrix, shift, found / np.linalg.norm(found), tiny)
                found = found - vectors[:, :number] @ (vectors[:, :number].T @ found)
                found /= np.linalg.norm(found)
                value = float(found @ matrix @ found)
                wrong = float(np.linalg.norm(matrix @ found - value * found))
                if not low - margin <= value <= high + margin:
                    break
                if least <= margin and wrong >= least:  # as good as rounding allows; the one before is kept
                    found, wrong = last, least
                    value = float(found @ matrix @ found)
                    break
                least = wrong
                if step:  # the first quotient of a start from afar may mislead
                    shift = value
            if low - margin <= value <= high + margin and wrong <= margin:
                break
            if high - low <= margin / 4:
                raise ArithmeticError(f"no vector found for eigenvalue {number + 1}")
            low, high = halve(low, high)
        if not (count(value - 2 * margin) > number >= count(value + 2 * margin)):
            raise ArithmeticError(f"eigenvalue {number + 1} is not certified")
        sign = np.sign(found[np.abs(found).argmax()]) or 1.0
        values[number], vectors[:, number] = value, found * sign
    return values, vectors


@dataclass
class Fit:
    """What the fit list gives: its size, sums, eigenvalues, vectors, their shares, and how white its image is."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        """Rows less the mean, projected, over the root of the eigenvalue; NaN where a component has no variance."""
        mean = np.array([s / self.n for s in self.sums])
        roots = np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return (rows - mean) @ self.vectors / roots


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _most(rows: np.ndarray) -> int:
    return max(int(rows.max(initial=0)), -int(rows.min(initial=0)))


def _exact_products(rows: np.ndarray) -> np.ndarray:
    """``rows' rows`` of whole numbers, as exact 64-bit sums, by floating-point products where they are exact."""
    most = _most(rows)
    if most * most >= _LONG // max(1, len(rows)):
        raise OverflowError("products of these vectors do not fit into 64 bits")
    out = np.zeros((rows.shape[1], rows.shape[1]), np.int64)
    step = (1 << 53) // max(1, most * most)
    if not step:
        return rows.T @ rows
    for begin in range(0, len(rows), step):
        part = rows[begin : begin + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64)
    return out


def _summed(points: DataFrame, shift: list[int] | None) -> list[int]:
    """Exact sums over all vectors: of their entries, or of the products of their entries less ``shift``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bound = None, 0

        def emit():
            cells = total.reshape(-1)
            return pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(cells))), "value": pa.array(cells)})

        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch.column("x"))
            if shift is not None:
                if _most(rows) + max(map(abs, shift)) >= _LONG // 2:
                    raise OverflowError("products of these vectors do not fit into 64 bits")
                rows = rows - np.array(shift)
                most = _most(rows) ** 2 * len(rows)
                own = _exact_products(rows)
            else:
                most = _most(rows) * len(rows)
                if most >= _LONG:
                    raise OverflowError("sums of these vectors do not fit into 64 bits")
                own = rows.sum(0)
            if total is not None and bound + most >= _LONG:
                yield emit()
                total, bound = None, 0
            total, bound = own if total is None else total + own, bound + most
        if total is not None:
            yield emit()

    found = points.mapInArrow(add, "cell long, value long").groupBy("cell")
    rows = found.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()  # d or d * d rows
    return [int(r["value"]) for r in sorted(rows, key=lambda r: r["cell"])]


def covariance(n: int, sums: list[int], points: DataFrame) -> np.ndarray:
    """Covariance with divisor ``n`` of distinct vectors, each entry exact but for its last rounding."""
    d = len(sums)
    shift = [(2 * s + n) // (2 * n) for s in sums]  # the rounded mean
    off = [s - n * m for s, m in zip(sums, shift, strict=True)]
    products = _summed(points, shift)
    return np.array([[(n * products[i * d + j] - off[i] * off[j]) / (n * n) for j in range(d)] for i in range(d)])


def _identity_error(model: Fit, points: DataFrame) -> float:
    """Measured over the fit list: the largest absolute entry of the whitened covariance minus the identity."""
    k = len(model.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            if len(batch):
                rows = model.whiten(_matrix(batch.column("x")))
                total += np.concatenate([rows.sum(0), (rows.T @ rows).reshape(-1)])
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(total))), "value": pa.array(total)})

    found = points.mapInArrow(add, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.array([r["value"] for r in sorted(found.collect(), key=lambda r: r["cell"])]) / model.n
    mean, second = total[:k], total[k:].reshape(k, k)
    real = model.values > 0
    error = np.abs(second - np.outer(mean, mean) - np.eye(k))[np.ix_(real, real)]
    return float(error.max()) if error.size else None


def fit(points: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Learns from the distinct vectors ``x`` of a stored table; None if it has none."""
    n = points.count()
    if not n:
        return None
    sums = _summed(points, None)
    matrix = covariance(n, sums, points)
    values, vectors = leading(matrix, components)
    trace = float(np.trace(matrix))
    # A value below the rounding of the whole spectrum is no variance.
    values = np.where(values > 8 * len(matrix) * ROUND * trace, values, 0.0)
    model = Fit(n, sums, values, vectors, values / trace if trace > 0 else np.full(len(values), np.nan))
    model.identity_error = _identity_error(model, points)
    return model


def whiten(embeddings: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row per vector and leading component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``.

    Vectors that are null or hold null or non-finite entries are left out, as are those of another length than most
    distinct vectors have (of equally many, the longer). Repeated rows and null ids are rows like others, and equal
    vectors count once in the fit. A component without variance has a null ``whitened`` and ``explained`` 0, or null if
    nothing varies; ``identity_error`` is over the others, null without any. There are as many components as
    dimensions at most. No vectors: no rows. Sums beyond 64 bits raise ``OverflowError``. Other columns are left out.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col(vector_col), scale).alias("x"))
    rows = rows.filter("size(x) > 0")
    points = save(rows.select("x").distinct(), "points")
    sizes = points.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], SCHEMA)
    size = sizes["size"]
    model = fit(points.filter(F.size("x") == size), components)
    k = len(model.values)
    error = model.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("x"))
            reach = max(model.n * _most(x) + abs(s) for s in model.sums)
            if reach * reach * size >= _LONG:  # exact, and refused where the result is too great
                exact = [sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x.tolist()]
                if max(exact) >= _LONG:
                    raise OverflowError("a deviation does not fit into 64 bits")
                deviation = np.array(exact, np.int64)
            else:
                deviation = ((model.n * x - np.array(model.sums)) ** 2).sum(1)
            image = model.whiten(x).reshape(-1)
            n = len(batch)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(n), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                "n": pa.array(np.full(n * k, model.n)), "deviation": pa.array(np.repeat(deviation, k)),
                "whitened": pa.array(image, mask=np.isnan(image)),
                "explained": pa.array(np.tile(model.explained, n), mask=np.tile(np.isnan(model.explained), n)),
                "identity_error": pa.array([error] * (n * k), pa.float64()),
            })

    return rows.filter(F.size("x") == size).mapInArrow(project, SCHEMA)
