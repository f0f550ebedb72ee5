"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Sums and the centred scatter are made per task and added up; only d and d x d numbers, d the length of a vector, reach the driver.  The scatter is
factored with pivoting, the triangular factor is rotated from one side until its columns are orthogonal: their squared norms are the
eigenvalues of the scatter, the normalised columns its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import stored

# Entries become whole numbers of 1/64, moved up by a million.
SCALE, MOVED = 64, 1_000_000
EXACT = float(1 << 53)
ROWS = 4096


@dataclass
class Moments:
    """What is known of the fit list: rows, sums of the whole numbers, eigenvalues and vectors (columns) of their covariance, its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """Whole numbers x of a batch of vectors of length ``d``."""
    flat = pc.list_flatten(batch.column("_x"))
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.int64).reshape(batch.num_rows, d)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _add_up(rows: DataFrame, number_of: str, width: int, partial) -> list:
    """Sum of one array of ``width`` numbers per task over all tasks, element by element; these ``width`` numbers reach the driver."""
    parts = rows.mapInArrow(partial, f"n bigint, part array<{number_of}>")
    wide = "decimal(38,0)" if number_of == "bigint" else "double"
    spread = parts.select("n", F.posexplode("part").alias("at", "value"))
    total = spread.groupBy("at").agg(F.sum(F.col("value").cast(wide)).alias("value"), F.sum("n").alias("n")).collect()
    out = [0] * width
    for r in total:
        out[r["at"]] = r["value"]
    return [total[0]["n"] if total else 0, out]


def sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each entry, as whole numbers of any size."""
    def partial(batches):
        n, high, low = 0, np.zeros(d, dtype=np.int64), np.zeros(d, dtype=np.int64)
        for batch in _pieces(batches):
            x = _matrix(batch, d)
            n += len(x)
            high += (x >> 26).sum(axis=0)  # two halves: neither sum can leave 64 bits
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([np.r_[high, low].tolist()], pa.list_(pa.int64()))], names=["n", "part"])

    n, both = _add_up(rows, "bigint", 2 * d, partial)
    return n, [(int(both[k]) << 26) + int(both[d + k]) for k in range(d)]


def _centre(n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each entry as a whole number and a rest within half of one, so that x minus the mean loses nothing to rounding."""
    whole = [(2 * s + n) // (2 * n) for s in total]
    return np.array(whole, dtype=np.int64), np.array([(s - n * w) / n for s, w in zip(total, whole)])


def _scatter(rows: DataFrame, d: int, centred) -> np.ndarray:
    """Sum of products of the vectors that ``centred`` makes of a batch; only the upper triangle is added up."""
    def partial(batches):
        n, total = 0, None
        for batch in _pieces(batches):
            y = centred(batch)
            n += len(y)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            part = total[np.triu_indices(len(total))]
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([part], pa.list_(pa.float64()))], names=["n", "part"])

    _, flat = _add_up(rows, "double", d * (d + 1) // 2, partial)
    out = np.zeros((d, d))
    upper = np.triu_indices(d)
    out[upper] = flat
    return out + np.triu(out, 1).T


def pivoted_cholesky(scatter: np.ndarray, tolerance: float = 1e-12) -> np.ndarray:
    """Factor L (d x r, rows in the order of the scatter) with L L' = scatter; the largest remaining diagonal is the next pivot.

    It ends at rank r, when no remaining diagonal is above ``tolerance`` times the largest one.
    """
    rest = np.diag(scatter).astype(float).copy()
    limit = tolerance * max(rest.max(initial=0.0), 0.0)
    columns: list[np.ndarray] = []
    open_rows = np.ones(len(rest), dtype=bool)
    while open_rows.any():
        pivot = int(np.argmax(np.where(open_rows, rest, -np.inf)))
        if rest[pivot] <= limit:
            break
        column = scatter[:, pivot].astype(float).copy()
        for earlier in columns:
            column -= earlier * earlier[pivot]
        column = np.where(open_rows, column, 0.0) / np.sqrt(rest[pivot])
        column[pivot] = np.sqrt(rest[pivot])
        open_rows[pivot] = False
        rest -= np.where(open_rows, column * column, 0.0)
        columns.append(column)
    return np.array(columns).T.reshape(len(rest), len(columns))


def jacobi(factor: np.ndarray, sweeps: int = 30, tolerance: float = 1e-15) -> tuple[np.ndarray, np.ndarray]:
    """Squared column norms and normalised columns of the factor after rotations that make all columns orthogonal, largest first.

    Disjoint pairs of columns are rotated together, in rounds that meet every pair once per sweep.
    """
    a = factor.copy()
    r = a.shape[1]
    players = list(range(r)) + ([-1] if r % 2 else [])
    half = len(players) // 2
    for _ in range(sweeps if r > 1 else 0):
        worst, ring = 0.0, players[:]
        for _ in range(len(players) - 1):
            pairs = [(p, q) for p, q in zip(ring[:half], ring[half:][::-1]) if p >= 0 and q >= 0]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = np.array([min(x) for x in pairs]), np.array([max(x) for x in pairs])
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (left * left).sum(axis=0), (right * right).sum(axis=0), (left * right).sum(axis=0)
            size = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, np.finfo(float).tiny))
            worst = max(worst, size.max())
            turn = size > tolerance
            zeta = (beta - alpha) / np.where(turn, 2 * gamma, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            a[:, p], a[:, q] = c * left - s * right, s * left + c * right
        if worst <= tolerance:
            break
    values = (a * a).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], a[:, order] / np.sqrt(values[order])


def whole_numbers(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Vectors of finite entries as whole numbers x = floor(64 c) + 1000000, and their length.

    Left out are vectors that are null or hold a null or non-finite entry, or one so large that 64 c is not exact (2^53), and, as no covariance
    joins vectors of several lengths, all but those of the commonest length (the larger one at ties).
    """
    scaled = F.transform(F.col(vector), lambda c: c.cast("double") * SCALE)
    sound = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) * SCALE < EXACT))
    rows = df.select(F.col(key).alias("_id"), F.when(sound, F.transform(scaled, lambda c: F.floor(c) + MOVED)).alias("_x")).filter(
        F.col("_x").isNotNull() & (F.size("_x") > 0))
    rows = stored(rows, "whole")
    length = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return rows, 0
    return rows.filter(F.size("_x") == length["d"]), length["d"]


def fit(rows: DataFrame, d: int) -> Moments:
    """Eigenvalues and eigenvectors of the covariance (divisor n) of all rows of ``whole_numbers``."""
    n, total = sums(rows, d)
    whole, rest = _centre(n, total)
    scatter = _scatter(rows, d, lambda batch: (_matrix(batch, d) - whole) - rest)
    values, vectors = jacobi(pivoted_cholesky(scatter))
    return Moments(n, total, values / n, vectors, float(np.trace(scatter)) / n)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """One row per vector and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    The fit list are all vectors that remain (see ``whole_numbers``); repeated rows count as often as they stand, null keys too.  A component whose
    eigenvalue is zero (below 1e-12 of the largest) cannot be whitened: as many components are returned as the covariance has rank, 32 at most, so equal
    vectors, a single one or none give no rows.  ``deviation`` is exact; where it does not fit 64 bits it is null.
    """
    rows, d = whole_numbers(df, key, vector)
    kind = dict(rows.dtypes)["_id"]
    schema = f"_id {kind}, deviation bigint, whitened array<double>"
    found = fit(rows, d) if d else None
    most = min(components, len(found.values)) if found else 0
    if not most:
        empty = rows.limit(0).select(F.col("_id").alias(key))
        return empty.selectExpr(f"`{key}`", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error")
    n, total = found.n, found.sums
    whole, rest = _centre(n, total)
    remainder = [s - n * int(w) for s, w in zip(total, whole)]
    turn = found.vectors[:, :most] / np.sqrt(found.values[:most])

    def projected(batch):
        return ((_matrix(batch, d) - whole) - rest) @ turn

    def deviations(x):
        """Exact sums of squares: n * (x - whole) - remainder, in 64 bits where that is certain, else in whole numbers of any size."""
        y = x - whole
        bound = n * (np.abs(y).max(axis=1, initial=0).astype(float) + 1) + n
        near = d * bound * bound < 2.0 ** 62
        out = [None] * len(x)
        if near.any():
            square = ((n * y[near] - np.array(remainder, dtype=np.int64)) ** 2).sum(axis=1)
            for row, value in zip(np.flatnonzero(near), square.tolist()):
                out[row] = value
        for row in np.flatnonzero(~near):
            value = sum((n * int(v) - r) ** 2 for v, r in zip(y[row], remainder))
            out[row] = value if value < 1 << 63 else None
        return out

    def transformed(batches):
        for batch in _pieces(batches):
            x, w = _matrix(batch, d), projected(batch)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * most)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(deviations(x), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))],
                names=["_id", "deviation", "whitened"])

    white = stored(rows.mapInArrow(transformed, schema), "white")
    # The mean of the whitened vectors is the projection of x - S / n, summed over all rows: zero but for rounding, and taken off all the same.
    middle = np.array([r["m"] for r in white.select(F.posexplode("whitened").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m")).orderBy("at").collect()])

    def white_batch(batch):
        return np.asarray(pc.list_flatten(batch.column("whitened")).to_numpy(zero_copy_only=False)).reshape(batch.num_rows, most) - middle

    error = float(np.abs(_scatter(white.select("whitened"), most, white_batch) / n - np.eye(most)).max())
    explained = F.array(*[F.lit(float(v)) for v in found.values[:most] / found.trace])
    flat = white.select(F.col("_id").alias(key), "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return flat.select(key, (F.col("_at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.element_at(explained, F.col("_at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
