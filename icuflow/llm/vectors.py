"""Integer vectors and pivot distances, shared by the exact search and the code compression."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest scaled component: squares summed over 2^10 components then still fit in a long.
MOST = 1 << 26
# Sums of integer products below this are exact in doubles.
EXACT = 1 << 53


def whole(vec_col: str) -> Column:
    """The vector is there and every component is a finite number."""
    infinite = F.lit(float("inf"))
    return F.col(vec_col).isNotNull() & F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))


def integers(vec_col: str, scale: int) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def width_of(df: DataFrame, col: str = "v") -> int:
    return int(df.agg(F.max(F.size(col))).first()[0] or 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of integer lists as rows of ``width``; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    out = np.zeros((n, width), np.int64)
    if n and width:
        size = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy()
        if (size == width).all():
            out = flat.reshape(n, width).astype(np.int64)
        else:
            row = np.repeat(np.arange(n), size)
            out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    if out.size and np.abs(out).max() >= MOST:
        raise ValueError("a vector component is too large for exact 64-bit sums")
    return out


def numeric(x: np.ndarray) -> np.ndarray:
    """As doubles where sums of products are exact in them, otherwise as they are."""
    most = int(np.abs(x).max()) if x.size else 0
    return x.astype(np.float64) if 4 * most * most * max(x.shape[-1], 1) < EXACT else x


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row of ``x`` to each row of ``to``, from differences, so that rounding stays relative."""
    x, out = x.astype(np.float64), np.empty((len(x), len(to)))
    for k, t in enumerate(to.astype(np.float64)):
        gap = x - t
        out[:, k] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def far_apart(x: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different rows, each the farthest from those before it; the first has the largest norm."""
    if not len(x) or count <= 0:
        return x[:0]
    chosen, nearest = [], np.full(len(x), np.inf)
    at = int((x.astype(np.float64) ** 2).sum(1).argmax())
    while len(chosen) < count and nearest[at] > 0:
        chosen.append(at)
        nearest = np.minimum(nearest, distances(x, x[at:at + 1])[:, 0])
        at = int(nearest.argmax())
    return x[chosen]


def list_column(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as a column of lists."""
    n, width = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width), pa.int32()), pa.array(np.ascontiguousarray(x).ravel(), kind))
