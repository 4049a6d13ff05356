"""Embedding whitening by Chebyshev-filtered subspace iteration.

An entry c becomes the whole number floor(256 * c). Means, covariances and components are those of the distinct vectors (the fit list). The leading eigenvectors of
their covariance V are found without forming it: a block Q of a few columns goes through V Q = X'(X Q) / n with X centred, one pass over the distributed vectors for
each product. A polynomial of Chebyshev's recurrence in V damps what lies below the block's least Ritz value, QR and Rayleigh-Ritz follow, until the residuals of the
wanted pairs certify them: |V q - e q| is at most `tolerance` times the largest eigenvalue.

Scale: the fit list is made by one aggregate and written once. A pass is a job of its own over that table; each task holds one batch and a block of
dimensions x columns, and sums of tasks are added by an aggregate, so that dimensions x columns numbers come to the driver, however many vectors there are.

Defined results: rows whose vector is null or empty, or holds null, non-finite or entries with |256 * c| of 2^53 or more go. Vectors of other than the most frequent length (of
equals, the greater) go, too. Repeated rows and null ids have results of their own. Components without variance (at most 1e-13 of the largest) have no rows, so
equal vectors alone, one vector and an empty table give an empty table. deviation is null where it doesn't fit a long. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, discard, written

SCALE = 256
#: A component needs this share of the largest eigenvalue.
FLAT = 1e-13


def whole(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x: the usable rows as whole numbers."""
    c = F.transform(vector_col, lambda v: v.cast("double") * SCALE)
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(1 << 53)))
    usable = rows.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).withColumn("scaled vector", c).filter(F.coalesce(F.forall("scaled vector", lambda v: v.isNotNull()) & fine, F.lit(False)))
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), F.transform("scaled vector", lambda v: F.floor(v)).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A batch's vectors of whole numbers as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


@dataclass
class Fit:
    """The distinct vectors, written, with their number and sums."""

    table: DataFrame
    n: int
    sums: np.ndarray
    trace: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(s) / self.n for s in self.sums])

    def total(self, part, rows: int, columns: int) -> np.ndarray:
        """The sum of part(centred batch), a rows x columns matrix, over all batches: a row for each of its rows from a task, added up by Spark."""
        mean, dims = self.mean, self.dims

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((rows, columns))
            for b in batches:
                if b.num_rows:
                    sums += part(matrix(b.column(0), dims) - mean)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), *[pa.array(sums[:, j]) for j in range(columns)]], names=["i", *[f"c{j}" for j in range(columns)]])

        parts = self.table.mapInArrow(run, "i long, " + ", ".join(f"c{j} double" for j in range(columns)))
        out = np.zeros((rows, columns))
        for r in parts.groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(columns)]).collect():  # rows x columns numbers
            out[r[0]] = r[1:]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q: one pass."""
        return self.total(lambda x: x.T @ (x @ q), *q.shape) / self.n


def usual_length(vectors: DataFrame) -> int:
    found = vectors.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return found.dims if found else 0


def fit_list(vectors: DataFrame) -> Fit | None:
    """vectors: x of one length."""
    table = written(vectors.select("x").distinct(), "fit-list")
    first = table.first()
    if first is None:
        return None
    dims = len(first.x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for b in batches:
            n += b.num_rows
            x = matrix(b.column(0), dims)
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)  # neither overflows
            sums = [s + (int(h) << 32) + int(w) for s, h, w in zip(sums, high, low, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(list(range(dims)), pa.int64()), pa.array([n] * dims, pa.int64()), pa.array([str(s) for s in sums])], names=["i", "n", "s"])

    sums = table.mapInArrow(run, "i long, n long, s string").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    exact = {r.i: int(r.s) for r in sums}
    fit = Fit(table, sums[0].n, np.array([exact[i] for i in range(dims)], dtype=object))
    fit.trace = float(fit.total(lambda x: (x * x).sum(axis=0)[:, None], dims, 1).sum() / fit.n)
    return fit


def leading(fit: Fit, wanted: int, guard: int = 16, degree: int = 8, tolerance: float = 1e-13, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of V, falling, and unit eigenvectors (columns). guard: further columns of the block; degree: of the polynomial.

    Rounding keeps residuals above some 1e-14, so that a round that no longer improves on a residual of 100 tolerances ends it, too; otherwise it is an error."""
    k = min(fit.dims, wanted + guard)
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((fit.dims, k)))[0]
    best = np.inf
    for _ in range(rounds):
        vq = fit.times(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)  # Rayleigh-Ritz
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], np.finfo(float).tiny)
        residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / top
        if residual <= tolerance or (best <= 100 * tolerance and residual >= best / 2):
            return values[:wanted], q[:, :wanted]
        best = min(best, residual)
        half = max(values[-1], 1e-12 * top) / 2  # damp [0, 2 * half]: centre and half width are equal
        # scaled by its own value at the largest Ritz value, so that nothing overflows
        sigma = first = half / (top - half) if k < fit.dims else 0.5
        if k == fit.dims:  # the block spans everything: one more turn settles it
            q = np.linalg.qr(vq)[0] if values[-1] > 0 else np.linalg.qr(q)[0]
            continue
        before, now = q, (vq - half * q) * (sigma / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - sigma)
            before, now = now, (fit.times(now) - half * now) * (2 * after / half) - before * (sigma * after)
            sigma = after
        q = np.linalg.qr(now)[0]
    raise RuntimeError(f"eigenvectors did not settle: residual {best:.3g}")


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sums over dimensions of (n * x - S)^2; null beyond a long."""
    most = n * int(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in sums)
    if most * most * len(sums) < 1 << 63:
        d = n * x - sums.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for each usable row and component."""
    spark = rows.sparkSession
    bounded_batches(spark)
    vectors = written(whole(rows, id_col, vector_col), "vectors")
    dims = usual_length(vectors)
    vectors = vectors.filter(F.size("x") == dims)
    fit = fit_list(vectors) if dims else None
    if fit is None or fit.trace <= 0:
        return spark.createDataFrame([], SCHEMA)
    values, q = leading(fit, min(components, dims))
    count = int((values > FLAT * values[0]).sum())
    values, q = values[:count], q[:, :count]
    half = q / np.sqrt(values)
    means = fit.total(lambda x: (x @ half).sum(axis=0)[:, None], count, 1)[:, 0] / fit.n
    covariance = fit.total(lambda x: (x @ half - means).T @ (x @ half - means), count, count) / fit.n
    error = float(np.abs(covariance - np.eye(count)).max())
    n, sums, mean, explained = fit.n, fit.sums, fit.mean, values / fit.trace
    discard(fit.table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1), dims)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), count)))
            deviation = pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), count)))
            whitened = ((x - mean) @ half).ravel()
            each = [pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), pa.array(np.full(len(whitened), n)), deviation, pa.array(whitened), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(whitened), error))]
            yield pa.RecordBatch.from_arrays([ids, *each], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return vectors.mapInArrow(run, SCHEMA)
