"""Whitening of embeddings: leading components by FEAST contour integration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.session import materialize

#: A component c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components returned.
COMPONENTS = 16
#: Quadrature points on the upper half of a contour; eigenvalues that one contour takes before it is closed at the next gap; most passes of a contour.
POINTS, INSIDE, PASSES = 8, 4, 40
#: A gap of this share of the largest eigenvalue may hold the end of a contour.
GAP = 1e-7
#: Eigenvalues below this share of the largest (times the width) count as zero and have no component.
ZERO = 4e-15
#: Rows of one numpy pass.
STEP = 4096


def _whole(vector: Column) -> Column:
    """The vector as longs; null where it is null or holds an entry that is null, not finite, or has no long."""
    value = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    # beyond 2^53 a double has no fraction, beyond 2^62 the shifted value may have no long
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) > 2.0**56))
    return F.when(vector.isNotNull() & ~bad, F.transform(value, lambda x: x + F.lit(SHIFT)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of longs; a vector shorter than the widest one counts as filled up with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    if len(column) and (np.diff(offsets) == width).all():
        return flat[offsets[0] : offsets[-1]].reshape(len(column), width)
    found = np.full((len(column), width), SHIFT, np.int64)
    for row, i, j in zip(found, offsets, offsets[1:]):
        row[: j - i] = flat[i:j]
    return found


def _parts(batches: Iterator[pa.RecordBatch], at: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, STEP):
            part = batch.slice(k, STEP)
            column = part.column(at)
            yield part, _matrix(pa.concat_arrays([column]) if column.offset else column, width)


# --- exact statistics ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Statistics:
    """Of the fit list: its size, the sums per dimension and the covariance, rounded once from exact integers."""

    n: int
    sums: list[int]
    covariance: np.ndarray


def _exact_rows(matrix: np.ndarray) -> list[tuple[int, list[int]]]:
    """(row, exact sums) of matrix.T @ matrix; plain integers where a long could overflow."""
    largest = int(np.abs(matrix).max(initial=0))
    safe = largest * largest * max(len(matrix), 1) < 1 << 62
    product = matrix.T @ matrix if safe else matrix.astype(object).T @ matrix.astype(object)
    return list(enumerate(product.tolist()))


def statistics(fit: DataFrame, width: int) -> Statistics:
    """Exact sums over the one column of distinct vectors: first per dimension, then of products around a whole number near the mean."""
    one = fit.columns[0]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for part, matrix in _parts(batches, 0, width):
            n += len(matrix)
            total += matrix.astype(object).sum(axis=0) if np.abs(matrix).max(initial=0) > 1 << 48 else matrix.sum(axis=0)
        yield _texts([[n, *total]])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for part, matrix in _parts(batches, 0, width):
            for i, row in _exact_rows(matrix - centre):
                total[i] += row
        yield _texts([[i, *row] for i, row in enumerate(total)])

    n, *found = _summed(fit.select(one).mapInArrow(sums, "values array<string>").select(F.lit("sums").alias("row"), "values"))["sums"]
    if not n:
        return Statistics(0, [0] * width, np.zeros((width, width)))
    centre = np.array([round(s / n) if abs(s) < 1 << 52 else s // n for s in found], np.int64)
    rows = fit.select(one).mapInArrow(products, "values array<string>")
    gram = _summed(rows.select(F.element_at("values", 1).alias("row"), F.slice("values", 2, width).alias("values")))
    rest = [s - n * int(c) for s, c in zip(found, centre)]
    # n^2 times the covariance is a whole number: nothing is lost before the one division
    covariance = [[(n * gram[str(i)][j] - rest[i] * rest[j]) / (n * n) for j in range(width)] for i in range(width)]
    return Statistics(n, found, np.array(covariance).reshape(width, width))


def _texts(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([[str(x) for x in r] for r in rows], pa.list_(pa.string()))], names=["values"])


def _summed(rows: DataFrame) -> dict[str, list[int]]:
    """Sums of whole numbers per row label and place, as decimals of 38 digits: one row per label and place reaches the driver."""
    placed = rows.select("row", F.posexplode("values").alias("place", "value"))
    total = placed.groupBy("row", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("string").alias("value"))
    found: dict[str, dict[int, int]] = {}
    for r in total.collect():
        found.setdefault(r["row"], {})[r["place"]] = int(r["value"])
    return {label: [values[k] for k in sorted(values)] for label, values in found.items()}


# --- eigenvectors of a covariance ---------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix, by reflections."""
    a = np.array(matrix, float)
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(x)
        if norm:
            x /= norm
            a[k + 1 :, k:] -= 2 * np.outer(x, x @ a[k + 1 :, k:])
            a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix (its inertia)."""
    diagonal, off = tri
    least = np.finfo(float).tiny ** 0.5
    count, pivot = np.zeros(len(shifts), np.int64), np.ones(len(shifts))
    for k, d in enumerate(diagonal):
        pivot = d - shifts - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < least, least, pivot)
        count += pivot > 0
    return count


def brackets(matrix: np.ndarray, k: int) -> tuple[tuple, np.ndarray, np.ndarray]:
    """The tridiagonal form, and low and high bounds of the k highest eigenvalues by bisection on inertia counts, falling."""
    tri = tridiagonal(matrix)
    edge = np.abs(matrix).sum(axis=1).max() * (1 + 1e-12) + np.finfo(float).tiny
    low, high = np.full(k, -edge), np.full(k, edge)
    rank = np.arange(1, k + 1)
    while ((high - low) > GAP / 8 * edge).any():
        middle = (low + high) / 2
        above = count_above(tri, middle) >= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return tri, low, high


def contours(low: np.ndarray, high: np.ndarray, want: int) -> list[tuple[float, float, int]]:
    """(lower end, upper end, eigenvalues inside) of the intervals that hold the ``want`` highest eigenvalues, none cut at a cluster."""
    least = GAP * max(high[0], np.finfo(float).tiny)
    found, first, top = [], 0, float(high[0] + max(high[0] - low[0], least) + (high[0] - low[-1]) * 0.01)
    for k in range(len(low)):
        end = k + 1 == len(low)
        gap = np.inf if end else low[k] - high[k + 1]
        if end or gap > least and (k + 1 - first >= INSIDE or k + 1 >= want):
            bottom = float(low[k] - max(least, (high[first] - low[k]) * 0.01)) if end else float((low[k] + high[k + 1]) / 2)
            found.append((bottom, top, k + 1 - first))
            first, top = k + 1, bottom
            if k + 1 >= want:
                break
    return found


def feast(matrix: np.ndarray, bottom: float, top: float, inside: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs between two values, falling.

    A rational filter, the quadrature of (z - V)^-1 over a circle around the interval, is applied to a block of vectors; Rayleigh-Ritz on the block
    gives the pairs, and the block is filtered again until their residuals stand at rounding. ``inside`` is the inertia count: a pass that
    finds another number of pairs in the interval is repeated with a larger block.
    """
    n = len(matrix)
    centre, radius = (top + bottom) / 2, (top - bottom) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi / 2 * (1 - nodes)
    points = centre + radius * np.exp(1j * angles)
    solved = [np.linalg.inv(z * np.eye(n) - matrix) for z in points]
    size = min(n, max(inside + 4, 2 * inside))
    rng = np.random.default_rng(seed)
    block = rng.standard_normal((n, size))
    scale, best, before = np.abs(matrix).sum(axis=1).max(), None, np.inf
    for _ in range(PASSES):
        filtered = sum(w / 2 * np.real(radius * np.exp(1j * t) * (inverse @ block)) for w, t, inverse in zip(weights, angles, solved))
        basis, _ = np.linalg.qr(filtered)
        values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turns
        hit = (values > bottom) & (values < top)
        if hit.sum() == inside:
            residual = np.linalg.norm(matrix @ block[:, hit] - block[:, hit] * values[hit], axis=0).max(initial=0)
            if residual < before / 2:
                best, before = (values[hit][::-1], block[:, hit][:, ::-1]), residual
            elif residual < 1e-11 * scale:
                break
        elif size < n:
            size = min(n, size + inside)
            block = np.hstack([block, rng.standard_normal((n, size - block.shape[1]))])
    if best is None:
        raise ArithmeticError("the contour found another number of eigenvalues than the inertia count")
    return best


def components(covariance: np.ndarray, want: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` highest eigenvalues and, as columns, their unit eigenvectors; fewer if the rest of the spectrum is zero.

    Inertia counts find how many eigenvalues are above the rounding error of zero, and gaps to lay contours in; each contour's pairs are checked
    against the count. Equal eigenvalues fall into one contour, and any orthonormal basis of their space will do.
    """
    n = len(covariance)
    scale = np.abs(covariance).sum(axis=1).max(initial=0)
    if not n or not scale:
        return np.zeros(0), np.zeros((n, 0))
    matrix = covariance / scale
    tri, low, high = brackets(matrix, n)
    present = int(count_above(tri, np.array([ZERO * n * high[0]]))[0])
    want = min(want, present)
    values, vectors = [], []
    for bottom, top, inside in contours(low[:present], high[:present], want):
        found = feast(matrix, bottom, top, inside)
        values.append(found[0])
        vectors.append(found[1])
    values, vectors = (np.concatenate(values), np.hstack(vectors)) if values else (np.zeros(0), np.zeros((n, 0)))
    return values[:want] * scale, vectors[:, :want]


# --- the operator -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    statistics: Statistics
    values: np.ndarray
    vectors: np.ndarray

    def mean_parts(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as a whole number and the rest, so that a vector is centred before anything is rounded."""
        n, sums = self.statistics.n, self.statistics.sums
        whole = [s // n for s in sums]
        return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole)])

    def project(self, matrix: np.ndarray) -> np.ndarray:
        whole, rest = self.mean_parts()
        return ((matrix - whole).astype(float) - rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, matrix: np.ndarray) -> list[int | None]:
        """The exact sum of squares of n * x - S; null where it has no long."""
        n, sums = self.statistics.n, self.statistics.sums
        whole, _ = self.mean_parts()
        rest = [s - n * int(w) for s, w in zip(sums, whole)]
        centred = matrix - whole
        largest = n * (int(np.abs(centred).max(initial=0)) + 1)
        if largest * largest * max(len(sums), 1) < 1 << 62:
            scaled = n * centred - np.array(rest, np.int64)
            return (scaled * scaled).sum(axis=1).tolist()
        scaled = n * centred.astype(object) - np.array(rest, object)
        return [x if x < 1 << 63 else None for x in map(int, (scaled * scaled).sum(axis=1))]


def _identity_error(fit: DataFrame, model: Whitening, width: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    count = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(count), np.zeros((count, count))
        for _, matrix in _parts(batches, 0, width):
            found = model.project(matrix)
            sums += found.sum(axis=0)
            products += found.T @ found
        flat = np.concatenate([sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["place", "value"])

    total = fit.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).orderBy("place")
    flat = np.array([r["value"] for r in total.collect()]) / model.statistics.n
    mean, product = flat[:count], flat[count:].reshape(count, count)
    return float(np.abs(product - np.outer(mean, mean) - np.eye(count)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", want: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: (key, component, n, deviation, whitened, explained, identity_error).

    Entries become whole numbers; the fit list is each distinct vector once, all statistics are over it and exact. The components are the eigenvectors
    of its covariance with the highest eigenvalues, found by contour integration on the driver, whose memory holds matrices of the vectors'
    width and nothing that grows with the rows. Eigenvalues that are zero within rounding give no component, so that a table with fewer than
    two distinct vectors, or none, gives no rows.

    A vector that is null or holds a null, non-finite or absurdly large entry (beyond 2^56) is left out. Vectors of unequal length count as filled up
    with zeros. Rows with a null key and repeated rows are rows like any other; other columns are not looked at. ``deviation`` is null
    where it exceeds a long.
    """
    usable = df.select(F.col(f"`{key}`").alias("key"), _whole(F.col(f"`{vector}`")).alias("x")).where("x is not null")
    usable = materialize(usable, "vectors")
    width = usable.agg(F.max(F.size("x"))).first()[0] or 0
    padded = F.when(F.size("x") < width, F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x")))).otherwise(F.col("x"))
    fit = materialize(usable.select(padded.alias("x")).distinct(), "fit")
    known = statistics(fit, width)
    values, vectors = components(known.covariance, want)
    model = Whitening(known, values, vectors)
    count = len(values)
    kind = usable.schema["key"].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not count:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    error = _identity_error(fit, model, width)
    explained = values / np.trace(known.covariance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, matrix in _parts(batches, 1, width):
            rows = len(matrix)
            again = pa.array(np.repeat(np.arange(rows), count))
            columns = [
                part.column(0).take(again),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * count, known.n)),
                pa.array(model.deviations(matrix), pa.int64()).take(again),
                pa.array(model.project(matrix).ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.mapInArrow(run, schema).withColumnRenamed("key", key)
