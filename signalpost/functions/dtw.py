"""Dynamic time warping distance, computed for a whole Arrow batch of pairs at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed value: cells of one padded block of pairs, which bounds the memory of a Python worker.
BLOCK_CELLS = 1_000_000


def pad(series) -> tuple[np.ndarray, np.ndarray]:
    """Ragged series as a zero-padded matrix and their lengths."""
    sizes = np.array([0 if s is None else len(s) for s in series], dtype=np.int64)
    out = np.zeros((len(sizes), max(int(sizes.max(initial=0)), 1)))
    for row, values in enumerate(series):
        out[row, :sizes[row]] = values if sizes[row] else 0.0
    return out, sizes


def distances(a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray,
              squared: bool = True, limit: float = np.inf) -> np.ndarray:
    """Full warping distance of paired rows; an empty side gives infinity.

    With a ``limit`` the rows are given up, as infinity, once none of those unfinished can come below it.

    Cells of one anti-diagonal depend on the two diagonals before only, so each step works on a
    (pairs x diagonal) matrix.  ``squared`` is the square root of summed squares, else summed
    absolute differences.
    """
    pairs, n = a.shape
    m = b.shape[1]
    result = np.full(pairs, np.inf)
    limit = limit * limit if squared else limit
    older = np.full((pairs, n + 1), np.inf)  # column i + 1 holds row i of a diagonal
    last = np.full((pairs, n + 1), np.inf)
    end = a_size + b_size - 2
    for diagonal in range(n + m - 1):
        low, high = max(0, diagonal - m + 1), min(n - 1, diagonal)
        rows = np.arange(low, high + 1)
        gap = a[:, rows] - b[:, diagonal - rows]
        cost = gap * gap if squared else np.abs(gap)
        here = np.full((pairs, n + 1), np.inf)
        if diagonal == 0:
            here[:, 1] = cost[:, 0]
        else:
            before = np.minimum(np.minimum(last[:, low:high + 1], last[:, low + 1:high + 2]),
                                older[:, low:high + 1])
            here[:, low + 1:high + 2] = cost + before
        done = np.nonzero((end == diagonal) & (a_size > 0) & (b_size > 0))[0]
        result[done] = here[done, a_size[done]]
        if limit < np.inf:  # every way crosses this diagonal or the one before
            least = np.minimum(here.min(axis=1), last.min(axis=1))
            if not ((least <= limit) & (end > diagonal)).any():
                break
        older, last = last, here
    return np.sqrt(result) if squared else result


def paired_distances(a_series, b_series, squared: bool = True) -> np.ndarray:
    """Distances of two equally long lists of series, in blocks of bounded size."""
    out = np.empty(len(a_series))
    widest = max((len(s) for s in a_series if s is not None), default=1)
    step = max(1, BLOCK_CELLS // max(widest, 1))
    for at in range(0, len(a_series), step):
        a, a_size = pad(a_series[at:at + step])
        b, b_size = pad(b_series[at:at + step])
        out[at:at + step] = distances(a, a_size, b, b_size, squared)
    return out


@F.pandas_udf(DoubleType())
def _euclidean(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(paired_distances(a.tolist(), b.tolist(), True))


@F.pandas_udf(DoubleType())
def _absolute(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(paired_distances(a.tolist(), b.tolist(), False))


def dtw(a: Column, b: Column, cost: str = "squared") -> Column:
    """Warping distance of two arrays; ``cost`` is "squared" or "absolute"."""
    if cost not in ("squared", "absolute"):
        raise ValueError(f"unknown cost {cost}")
    return (_euclidean if cost == "squared" else _absolute)(a, b)
