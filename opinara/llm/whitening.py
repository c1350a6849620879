"""Whitening of embeddings by spectral divide and conquer (operator 11).

Spark adds up the covariance; its dimension, not the number of rows, bounds what the driver
gets. There the symmetric matrix is split in two again and again: the orthogonal polar factor
of the covariance less a shift, found by dynamically weighted Halley steps (QDWH), has the
eigenvalues one and minus one, so it gives the projector on the invariant subspace above the
shift. Subspaces of one dimension are components. Mean and components are then
broadcast, and every row is whitened in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from opinara.session import cut_lineage

#: Embeddings are put on a grid of whole numbers, so that equal ones are found and sums are exact.
GRID, OFFSET = 64, 1_000_000
#: Components kept, at most.
COMPONENTS = 16
#: An eigenvalue counts as zero below this part of the largest; its component has no scale.
FLAT = 1e-12
#: Halley steps end when an iterate moves by less than this; never more than so many.
SETTLED, MOST_STEPS = 1e-10, 30
#: Coupling that may be left between the two halves of a split, as a part of the matrix.
COUPLING = 1e-13
#: Shifts tried for a split, in standard deviations of the eigenvalues around their mean.
SHIFTS = (0.0, 0.07, -0.07, 0.19, -0.19, 0.37, -0.37, 0.61, -0.61, 0.83, -0.83)
_EPS = np.finfo(float).eps


def polar(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QR-based dynamically weighted Halley steps."""
    size = len(matrix)
    x = matrix / np.linalg.norm(matrix)  # no eigenvalue beyond one
    low = _EPS / 4  # a bound of the least one: smaller ones cost a step more
    for _ in range(MOST_STEPS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        a = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)), 0.0))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))
        after = b / c * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        low = min(low * (a + b * square) / (1 + c * square), 1.0)
        moved = np.linalg.norm(after - x)
        x = (after + after.T) / 2
        if moved < SETTLED and abs(1 - low) < SETTLED:
            break
    return x


def _split(matrix: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of the larger and of the smaller eigenvalues.

    None if all eigenvalues are the same to working precision: then every basis is right.
    """
    size = len(matrix)
    mean = np.trace(matrix) / size
    spread = np.linalg.norm(matrix - mean * np.eye(size)) / np.sqrt(size)
    if spread <= size * _EPS * scale:
        return None
    best = None
    start = np.random.default_rng(size).standard_normal((size, size))
    for shift in SHIFTS:
        # the mean lies between the least and the largest eigenvalue
        projector = (polar(matrix - (mean + shift * spread) * np.eye(size)) + np.eye(size)) / 2
        rank = round(np.trace(projector))
        if not 0 < rank < size:
            continue
        upper, _ = np.linalg.qr(projector @ start[:, :rank])
        both, _ = np.linalg.qr(projector @ upper, mode="complete")
        upper, lower = both[:, :rank], both[:, rank:]
        coupling = np.linalg.norm(lower.T @ matrix @ upper)
        if best is None or coupling < best[0]:
            best = coupling, upper, lower
        if coupling <= COUPLING * scale:
            break  # else an eigenvalue is too close to the shift
    return best[1:] if best else None


def eigenpairs(matrix: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Equal eigenvalues have some orthonormal basis of their subspace. Subspaces are entered only as
    far as their components are wanted.
    """
    size = len(matrix)
    most = size if most is None else min(most, size)
    scale = float(np.linalg.norm(matrix))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    open_ = [(matrix, np.eye(size))] if size else []
    while open_ and len(values) < most:  # the subspace of the largest eigenvalues is on top
        block, basis = open_.pop()
        halves = _split(block, scale) if len(block) > 1 else None
        if halves is None:
            for k in range(len(block)):
                vector = basis[:, k] / np.linalg.norm(basis[:, k])
                values.append(float(vector @ matrix @ vector))
                vectors.append(vector)
            continue
        upper, lower = halves
        for half in (lower, upper):
            inner = half.T @ block @ half
            open_.append(((inner + inner.T) / 2, basis @ half))
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.column_stack(vectors)[:, order] if vectors else np.zeros((size, 0))


@dataclass
class Whitening:
    """What was learned from ``n`` vectors: exact sums, components as columns, their eigenvalues."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def scales(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)

    def centred(self, grid: np.ndarray) -> np.ndarray:
        """``n * x - S`` per entry, exact."""
        return self.n * grid - self.sums

    def whiten(self, grid: np.ndarray) -> np.ndarray:
        return self.centred(grid) / self.n @ self.scales


def on_grid(embedding: Column) -> Column:
    return F.transform(embedding, lambda c: F.floor(GRID * c.cast("double")) + OFFSET).cast("array<bigint>")


def _rows(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x``: the rows whose vector is whole, on the grid."""
    vector = F.col(vector_col)
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return embeddings.filter(vector.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(id_col).alias("vec_id"), on_grid(vector).alias("x"))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return np.asarray(batch.column("x").flatten(), np.int64).reshape(len(batch), size)


def _sum_matrix(rows: DataFrame, of, size: int, wide: int) -> np.ndarray:
    """Sum over the partitions of the symmetric matrix ``of(vectors)``, ``wide`` rows and columns."""
    upper = np.triu_indices(wide)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for batch in batches:
            total += of(_matrix(batch, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])], names=["i", "j", "v"])

    table = rows.select("x").mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((wide, wide))
    i, j, v = (np.asarray(table[c].combine_chunks()) for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v
    return out


def _dimension(rows: DataFrame) -> int:
    """The length that most vectors have, the larger of two as frequent; 0 without vectors."""
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return lengths["size"] if lengths else 0


def fit_whitening(rows: DataFrame, size: int, most: int = COMPONENTS) -> Whitening | None:
    """Learn from the distinct vectors ``x`` of ``rows`` (grid vectors of one length); None without any.

    The driver gets sums, covariance and the check of the result: numbers of dimensions squared.
    """
    distinct = cut_lineage(rows.select("x").distinct())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            n, total = n + len(batch), total + _matrix(batch, size).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size, dtype=np.int32)), pa.array(total), pa.array(np.full(size, n))], names=["pos", "s", "n"])

    counts = distinct.mapInArrow(add_up, "pos int, s long, n long").groupBy("pos").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n")).filter("n > 0").orderBy("pos").collect()  # one row a dimension
    if not counts:
        return None
    model = Whitening(counts[0]["n"], np.array([r["s"] for r in counts], np.int64), np.zeros((size, 0)), np.zeros(0), 0.0)

    def scatter(x: np.ndarray) -> np.ndarray:
        y = model.centred(x) / model.n
        return y.T @ y

    covariance = _sum_matrix(distinct, scatter, size, size) / model.n
    values, vectors = eigenpairs(covariance, most)
    keep = values > FLAT * max(values.max(initial=0.0), 0.0)
    model.values, model.components, model.trace = values[keep], vectors[:, keep], float(np.trace(covariance))
    if keep.any():
        def check(x: np.ndarray) -> np.ndarray:
            y = np.column_stack([model.whiten(x), np.ones(len(x))])
            return y.T @ y

        sums = _sum_matrix(distinct, check, size, int(keep.sum()) + 1) / model.n
        mean = sums[:-1, -1]  # zero but for rounding
        model.identity_error = float(np.abs(sums[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max())
    return model


def whiten(embeddings: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per whole vector: ``vec_id, n, deviation, whitened`` (an array, the first component
    first), ``explained`` (per component) and ``identity_error``.

    Entries become ``floor(64 * c) + 1000000``. Means and covariance are those of the distinct
    vectors, ``n`` of them; ``deviation`` is the sum over the dimensions of ``(n * x - S)^2``, exact (an
    error if it does not fit a long). Components are numbered by falling eigenvalue; those whose eigenvalue is
    zero have no scale and are left out, so vectors that are all equal have empty arrays.

    Rows whose vector is null or holds null, NaN or infinity are left out, as are vectors of another length than
    most (of two lengths as frequent the larger one stays). Repeated rows are learned from once and each
    returned; null ids are kept; other columns are ignored whatever their names. No rows, no result.
    """
    rows = _rows(embeddings, id_col, vector_col)
    size = _dimension(rows)
    rows = rows.filter(F.size("x") == size)
    schema = (f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, n long, deviation long, whitened array<double>, "
              "explained array<double>, identity_error double")
    model = fit_whitening(rows, size, most) if size else None
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    sent = rows.sparkSession.sparkContext.broadcast(model)  # dimensions times components

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        explained = model.values / model.trace if model.trace else model.values
        k = len(explained)
        for batch in batches:
            x, m = _matrix(batch, size), len(batch)
            y = model.centred(x)
            if m and np.square(y.astype(float)).sum(axis=1).max() > 9e18:
                raise OverflowError("the squared deviations do not fit a long")
            ends = pa.array(np.arange(m + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(np.full(m, model.n)), pa.array(np.square(y).sum(axis=1)),
                 pa.ListArray.from_arrays(ends, pa.array(model.whiten(x).ravel())),
                 pa.ListArray.from_arrays(ends, pa.array(np.tile(explained, m))), pa.array(np.full(m, model.identity_error))],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(apply, schema)


def component_rows(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from one."""
    each = F.arrays_zip("whitened", "explained")
    return whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(each).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")
