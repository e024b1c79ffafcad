"""Embedding whitening: principal components of unit variance.

The scatter of the vectors, centred before multiplying, is factored by a
Cholesky decomposition that takes the largest remaining pivot first (so it
stops at the rank); one-sided Jacobi rotations then make the columns of the
triangular factor orthogonal. The rotated columns' squared norms are the
eigenvalues, the normalised columns the components, and the scatter is never
rotated itself, which keeps small eigenvalues accurate.

Each entry c becomes the whole number x = floor(scale * c) + shift, so counts
and sums are exact. Spark does the passes over the vectors: sums; the scatter
around the exact mean (one matrix per task, its entries summed by Spark); the
covariance of the whitened rows, as a check; the rows themselves. Only sums,
matrices and components (d x d numbers) reach the driver.

Defined results: vectors that are null or hold null, NaN or infinite entries
take no part, nor do those with an entry beyond 2^52 after scaling (it is no
exact whole number) and those of another length than the commonest (of equally
common ones the longest); empty vectors have no components. Repeated and null
ids pass through row by row; extra columns are not read. Directions without
variance have no component, so fewer than ``most`` may come back; one row, or
only equal rows, give none. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pivots below this share of the largest one count as no variance.
RANK_TOLERANCE = 1e-13
#: Rotation stops when all columns are orthogonal to this cosine.
JACOBI_TOLERANCE = 1e-15
MOST_SWEEPS = 60
#: Scaled entries beyond this are not exact whole numbers.
EXACT = float(2 ** 52)
#: Vectors handled at once.
AT_ONCE = 8_192

ROWS = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# -- the decomposition ----------------------------------------------------------
def pivoted_cholesky(a: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """L (d x rank) and order, with a[order][:, order] = L L^T.

    The largest remaining pivot comes first; the rest is nil (to
    ``tolerance`` of the first pivot) once that is.
    """
    a = np.array(a, np.float64)
    d = len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    first = a.diagonal().max(initial=0.0)
    for k in range(d):
        rest = a.diagonal()[k:]
        p = k + int(np.argmax(rest))
        if not a[p, p] > tolerance * first:
            return factor[:, :k], order
        for m in (order, factor, a):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The factor times rotations, its columns orthogonal (one-sided Jacobi)."""
    b = np.array(factor, np.float64)
    for _ in range(MOST_SWEEPS):
        turned = False
        for i in range(b.shape[1] - 1):
            for j in range(i + 1, b.shape[1]):
                x, y = b[:, i], b[:, j]
                xx, yy, xy = x @ x, y @ y, x @ y
                if abs(xy) <= JACOBI_TOLERANCE * np.sqrt(xx * yy):
                    continue
                turned = True
                zeta = (yy - xx) / (2 * xy)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                b[:, i], b[:, j] = c * (x - t * y), c * (y + t * x)
        if not turned:
            break
    return b


def components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a scatter matrix."""
    factor, order = pivoted_cholesky(scatter)
    b = orthogonal_columns(factor)
    values = (b * b).sum(axis=0)
    back = np.empty_like(b)
    back[order] = b / np.sqrt(values)
    by = np.argsort(-values, kind="stable")
    return values[by], back[:, by]


# -- whole numbers ----------------------------------------------------------------
def _whole(vectors: pa.Array, d: int, scale: float, shift: int) -> np.ndarray:
    return (np.floor(scale * _flat(vectors).reshape(-1, d)) + shift).astype(np.int64)


def _flat(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False)


def _from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: longs where they fit, else Python's integers."""
    most = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums))
    if most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviation(m: np.ndarray) -> list[int | None]:
    """Sum of squares per row, exact; None where a long doesn't hold it."""
    most = max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    if most * most * m.shape[1] >= 1 << 63:
        m = m.astype(object)
    return [v if v < 1 << 63 else None for v in map(int, (m * m).sum(axis=1))]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(k, AT_ONCE)


def _entries(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(matrix.shape)
    return pa.RecordBatch.from_arrays(
        [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(matrix.ravel(), pa.float64())],
        names=["i", "j", "v"])


def _matrix(entries: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Entries of the tasks' matrices, summed by Spark: d x d numbers arrive."""
    made = np.zeros(shape)
    for r in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        made[r.i, r.j] = r.v
    return made


# -- the operator ------------------------------------------------------------------
def usable(df: DataFrame, id_col: str, vector_col: str, scale: float, shift: int) -> tuple[DataFrame, int]:
    """Rows (id, v: array<double>) that take part, and their length."""
    v = F.col(vector_col).cast("array<double>")
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit((EXACT - abs(shift)) / abs(scale))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(fits, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths.d if lengths else 0
    return rows.where(F.size("v") == d), d


def whiten(df: DataFrame, id_col: str, vector_col: str, most: int = 8, scale: float = 1024.0, shift: int = 100_000) -> DataFrame:
    """Per row and component (1 to ``most``, by falling eigenvalue): id_col,
    component, n, deviation, whitened, explained, identity_error.

    ``whitened``: the row less the mean, projected on the component, over the
    eigenvalue's root; ``explained``: the eigenvalue's share of the trace;
    ``deviation``: sum over dimensions of (n x - S)^2; ``identity_error``: the
    largest entry of the whitened rows' covariance minus the identity.
    """
    spark = df.sparkSession
    rows, d = usable(df, id_col, vector_col, scale, shift)
    none = spark.createDataFrame([], ROWS).withColumnRenamed("id", id_col)
    if not d:
        return none

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = _whole(batch.column(0), d, scale, shift)
            # in two parts, so that no sum leaves a long
            high, low = x >> 26, x & ((1 << 26) - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([len(x)] * d, pa.int64()),
                 pa.array(high.sum(axis=0)), pa.array(low.sum(axis=0))], names=["j", "n", "high", "low"])

    summed = rows.select("v").mapInArrow(totals, "j int, n long, high long, low long").groupBy("j").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("j").collect()
    n, sums = summed[0].n, [(r.high << 26) + r.low for r in summed]

    def centred(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
        m = _from_mean(_whole(batch.column(column), d, scale, shift), n, sums)
        return m, m.astype(np.float64) / n

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in _slices(batches):
            y = centred(batch, 0)[1]
            total += y.T @ y
        yield _entries(total)

    v = _matrix(rows.select("v").mapInArrow(scatter, "i int, j int, v double"), (d, d)) / n
    values, vectors = components((v + v.T) / 2)
    kept = min(most, len(values))
    if not kept:
        return none
    axes = vectors[:, :kept] / np.sqrt(values[:kept])
    explained = values[:kept] / v.trace()

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # count, mean and scatter of what came so far, merged batch by batch
        have, mean, total = 0, np.zeros(kept), np.zeros((kept, kept))
        for batch in _slices(batches):
            w = centred(batch, 0)[1] @ axes
            m = len(w)
            own = w.mean(axis=0)
            away, w = own - mean, w - own
            total += w.T @ w + np.outer(away, away) * (have * m / (have + m))
            have, mean = have + m, mean + away * (m / (have + m))
        if have:
            # around the rows' common mean, which is nil by construction
            yield _entries(total + have * np.outer(mean, mean))

    covariance = _matrix(rows.select("v").mapInArrow(gram, "i int, j int, v double"), (kept, kept)) / n
    error = float(np.abs(covariance - np.eye(kept)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            m, y = centred(batch, 1)
            size = len(y)
            take = np.repeat(np.arange(size), kept)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(take)), pa.array(np.tile(np.arange(1, kept + 1), size), pa.int32()),
                pa.array(np.full(size * kept, n), pa.int64()), pa.array(_deviation(m), pa.int64()).take(pa.array(take)),
                pa.array((y @ axes).ravel(), pa.float64()), pa.array(np.tile(explained, size), pa.float64()),
                pa.array(np.full(size * kept, error), pa.float64()),
            ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "v").mapInArrow(project, ROWS).withColumnRenamed("id", id_col)
