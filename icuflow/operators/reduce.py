"""Sums of fixed-length arrays over all rows: the one aggregation that the fitting code is built on."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Arrays of so many tasks are added on the driver itself.
FEW = 4
# Bytes of a task's share of a table that is read over and over.
TASK_BYTES = 1 << 25


def sum_arrays(df: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], width: int, parts: int | None = None) -> np.ndarray:
    """Sum of ``function(batch)``, ``width`` numbers, over the Arrow batches of ``df``.

    A task adds up its batches and hands on one array; the arrays are added place by
    place in a second stage, so that neither a task nor the driver holds more than a few
    arrays, however many tasks there are.  ``parts`` says that ``df`` has so many
    partitions; of up to ``FEW`` the arrays need no second stage.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += function(b)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])

    arrays = df.mapInArrow(run, "part array<double>")
    if parts is not None and parts <= FEW:
        return sum((np.asarray(a.values) for a in arrays.toArrow().column("part")), np.zeros(width))
    places = arrays.select(F.posexplode("part").alias("place", "x")).where("x <> 0")
    got = places.groupBy("place").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(width)
    out[got.column("place").to_numpy()] = got.column("x").to_numpy()
    return out


def packed(df: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``df`` (about ``size`` bytes) persisted for many passes, in as few partitions as give tasks of ``TASK_BYTES``.
    The caller releases it with ``unpersist``."""
    parts = max(1, -(-size // TASK_BYTES))
    return df.repartition(parts).persist(), parts


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` numbers as a matrix."""
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def feature_row(cols: Iterable[str]):
    """The features as one array column."""
    return F.array(*[F.col(c).cast("double") for c in cols])
