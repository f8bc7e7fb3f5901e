"""Embedding whitening by shifted CholeskyQR.

Entries become fixed-point integers x = floor(SCALE * c) + OFFSET, so counts,
sums and squared deviations are exact.  The centred rows a = (n*x - S) / n
form a tall matrix A that no task ever holds.  Each pass solves the rows
against the triangular factors found so far (forward substitution, batch by
batch), and the partitions' Gram matrices of the result are summed by Spark:

    G = Q'Q,  G + s*I = R'R (Cholesky),  Q <- Q inv(R),  factor <- R * factor

The first pass adds the shift s, which keeps an ill-conditioned or
rank-deficient Gram positive definite; later passes shift only where the plain
factorisation fails, and the passes end when Q'Q is the identity to TOLERANCE.
Then A = Q * factor, and the SVD of the small factor gives the components
(right singular vectors) and the eigenvalues of the covariance (squared
singular values over n).  Only d*d numbers reach the driver, d the dimension.

Rows whose vector is null, or holds null or non-finite entries, take no part;
so do vectors shorter than the longest one, whose missing entries count as
null.  Repeated rows and ids are rows of their own; a null id stays null.
Components without variance (RANK_TOLERANCE) are left out, so constant or
single rows give no row; an empty table gives none.  Entries whose fixed-point
value leaves 2**40 raise an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import narrow

SCALE = 1024
OFFSET = 100_000
LIMIT = 1 << 40
COMPONENTS = 8
TOLERANCE = 1e-12
RANK_TOLERANCE = 1e-12
PASSES = 10


@dataclass(frozen=True)
class Whitening:
    """n rows with sums S; column k of ``components`` is the unit eigenvector of ``eigenvalues[k]``, which fall."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    passes: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exactly."""
        return self.n * x - self.sums

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        return (self.deviations(x) / self.n) @ (self.components[:, :k] / np.sqrt(self.eigenvalues[:k]))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows whose vector is whole and as long as the longest."""
    kept = narrow(vectors, id_col, vector_col).toDF("vec_id", "v").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    kept = kept.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & (F.size("v") > 0))
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    return kept.where(F.size("v") == F.lit(longest))


def fixed_point(column: pa.Array) -> np.ndarray:
    """One row of long x for every vector of the Arrow list column."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE) + OFFSET
    if np.abs(x).max() >= LIMIT:
        raise ValueError(f"an entry is too large for fixed point: {np.abs(x).max() / SCALE}")
    return x.astype(np.int64).reshape(len(column), -1)


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q with Q @ factor = rows, for an upper triangular factor."""
    q = np.asfortranarray(rows)
    for j in range(factor.shape[0]):
        q[:, j] = (q[:, j] - q[:, :j] @ factor[:j, j]) / factor[j, j]
    return q


def _counts(kept: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows and the sums of every dimension, exactly."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = fixed_point(batch.column(0))
                n, sums = n + len(x), sums + x.sum(0)
        if n:
            yield pa.RecordBatch.from_pydict({"j": np.arange(len(sums), dtype=np.int32), "n": np.full(len(sums), n), "s": sums})

    parts = kept.select("v").mapInArrow(run, "j int, n long, s long")
    found = sorted(parts.groupBy("j").agg(F.sum("n"), F.sum(F.col("s").cast("decimal(38,0)"))).collect())
    return (int(found[0][1]), np.array([int(r[2]) for r in found])) if found else (0, np.zeros(0, np.int64))


def _gram(kept: DataFrame, rows_of) -> np.ndarray:
    """Sum over all rows of the outer products of ``rows_of(x)``; every partition adds one small matrix."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                q = rows_of(fixed_point(batch.column(0)))
                total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": np.arange(len(total), dtype=np.int32), "g": pa.array(total.tolist(), pa.list_(pa.float64()))})

    parts = kept.select("v").mapInArrow(run, "i int, g array<double>").select("i", F.posexplode("g").alias("j", "g"))
    found = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toArrow()
    i, j = found["i"].to_numpy(), found["j"].to_numpy()
    out = np.zeros((i.max() + 1, j.max() + 1))
    out[i, j] = found["g"].to_numpy()
    return (out + out.T) / 2


def cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular R with R'R = gram + s*I; s is 0 unless asked for or needed."""
    d = len(gram)
    unit = (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(gram, 2)
    shift = 11 * unit if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 11 * unit)


def fit(kept: DataFrame) -> Whitening | None:
    """The whitening of all rows that ``usable`` gave; None without rows or without variance."""
    n, sums = _counts(kept)
    if not n:
        return None
    if n * LIMIT >= 1 << 62 and n * int(np.abs(sums).max()) >= 1 << 62:
        raise ValueError("too many rows for exact 64-bit deviations")
    sc = kept.sparkSession.sparkContext
    factors: list[np.ndarray] = []
    while True:
        shared = sc.broadcast(factors)

        def rows_of(x: np.ndarray) -> np.ndarray:
            rows = (n * x - sums) / n
            for r in shared.value:
                rows = solve_rows(rows, r)
            return rows

        gram = _gram(kept, rows_of)
        if not gram.any():
            return None
        if len(factors) == PASSES or (factors and np.abs(gram - np.eye(len(gram))).max() <= TOLERANCE):
            break
        factors.append(cholesky(gram, n, shifted=not factors))
    composed = factors[0]
    for r in factors[1:]:
        composed = r @ composed
    _, singular, right = np.linalg.svd(composed)
    values = singular**2 / n
    rank = int((singular > RANK_TOLERANCE * singular[0]).sum())
    right = right[:rank]
    right = right * np.sign(right[np.arange(rank), np.abs(right).argmax(1)])[:, None]
    return Whitening(n, sums, right.T, values[:rank], float(values.sum()), len(factors))


SCHEMA = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten_vectors(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each usable row and component: its whitened coordinate, with the fit's figures.

    ``deviation`` is the exact squared length of n*x - S, ``explained`` the
    component's share of the variance, ``identity_error`` the largest absolute
    entry of the whitened rows' covariance minus the identity, measured over
    all rows.
    """
    kept = usable(vectors, id_col, vector_col)
    fitted = fit(kept)
    if fitted is None:
        return kept.sparkSession.createDataFrame([], SCHEMA)
    k = min(components, len(fitted.eigenvalues))
    shared = kept.sparkSession.sparkContext.broadcast(fitted)
    moments = _gram(kept, lambda x: np.hstack([shared.value.whiten(x, k), np.ones((len(x), 1))])) / fitted.n
    mean = moments[k, :k]
    error = float(np.abs(moments[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        share = own.eigenvalues[:k] / own.trace
        for batch in batches:
            if not batch.num_rows:
                continue
            x = fixed_point(batch.column("v"))
            z = own.deviations(x)
            if len(own.sums) * int(np.abs(z).max()) ** 2 >= 1 << 63:
                z = z.astype(object)
            squares = pa.array((z * z).sum(1).tolist(), pa.decimal128(38, 0))
            take = np.repeat(np.arange(len(x)), k)
            rows = len(take)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(take)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(rows, own.n, np.int64)),
                    squares.take(pa.array(take)),
                    pa.array(own.whiten(x, k).ravel()),
                    pa.array(np.tile(share, len(x))),
                    pa.array(np.full(rows, error)),
                ],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )

    return kept.mapInArrow(run, SCHEMA)
