"""Vector code compression: product codes learnt by integer k-means, assigned with pivot bounds.

Vectors become integers, floor(scale * x), and are cut into ``parts`` equal consecutive
parts.  The codebook of a part starts as that part of the vectors with the smallest ids.
A round assigns every part to the nearest entry (ties to the lower index) and moves each
entry to the floor of its parts' mean; entries without parts stay.

Assignment is LAESA: the distances of every part to ``PIVOTS`` fixed pivots are computed
once and staged.  A round computes the entries' distances to the pivots; the largest
difference over the pivots is a lower bound of a part's distance to an entry.  Entries are
evaluated exactly, as integers, in the order of that bound, and a part stops at the first
bound beyond its best distance.

Tasks add up their parts by entry before the shuffle; only the codebooks (parts x entries,
whatever the number of rows) pass through the driver.

Defined cases: rows whose vector is null or holds a null or non-finite component are left
out; shorter vectors, and lengths that the parts do not divide, count as ended by zeros; an
empty vector is the zero vector; of rows repeating an id the smaller vector comes first in
the first codebook; null ids come last there and are returned; fewer rows than entries give
as many entries; an empty table gives an empty result; a scaled component of 2^26 or more is
an error; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm import vectors
from icuflow.llm.common import discard, stage

PARTS, ENTRIES, ROUNDS = 4, 256, 4
PIVOTS = 8
ROWS_AT_ONCE = 2048
WAVE = 8


def first_entries(rows: DataFrame, width: int, entries: int, parts: int) -> np.ndarray:
    """(parts, entries, part width): the vectors with the smallest ids, cut into parts."""
    least = rows.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    x = vectors.matrix(pa.array([r["v"] for r in least], pa.list_(pa.int64())), width)
    return np.ascontiguousarray(x.reshape(len(x), parts, width // parts).swapaxes(0, 1))


class Book:
    """Entries of one part position and their distances to the fixed pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries = vectors.numeric(entries)
        self.known = vectors.distances(entries, pivots)

    def nearest(self, x: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row of ``x`` and the squared distance, exactly."""
        out = [self._nearest(x[k:k + ROWS_AT_ONCE], dist[k:k + ROWS_AT_ONCE]) for k in range(0, len(x), ROWS_AT_ONCE)]
        return np.concatenate([i for i, _ in out]), np.concatenate([d for _, d in out])

    def _nearest(self, x: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.zeros((len(x), len(self.entries)))
        for p in range(dist.shape[1]):
            np.maximum(low, np.abs(dist[:, p, None] - self.known[None, :, p]), out=low)
        # Bounds are rounded down a little, so that rounding never prunes an equal distance.
        low = np.maximum(low * (1 - 1e-9) - 1e-6, 0) ** 2
        order = np.argsort(low.astype(np.float32), axis=1, kind="stable")
        low = np.take_along_axis(low, order, 1)
        # The order is by rounded bounds; what a part may stop at is the least bound still ahead.
        low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
        at = np.zeros(len(x), np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max)
        open_ = np.arange(len(x))
        x = x.astype(self.entries.dtype) if self.entries.dtype == np.float64 and vectors.numeric(x).dtype == np.float64 else x.astype(np.int64)
        entries = self.entries if x.dtype == np.float64 else self.entries.astype(np.int64)
        for k in range(0, order.shape[1], WAVE):
            open_ = open_[low[open_, k] <= best[open_]]
            if not len(open_):
                break
            which = order[open_, k:k + WAVE]
            gap = entries[which] - x[open_, None, :]
            square = np.einsum("awd,awd->aw", gap, gap).astype(np.int64)
            least = square.min(1)
            index = np.where(square == least[:, None], which, len(self.entries)).min(1)
            better = (least < best[open_]) | ((least == best[open_]) & (index < at[open_]))
            at[open_[better]], best[open_[better]] = index[better], least[better]
        return at, best


def _columns(b: pa.RecordBatch, width: int, parts: int, pivots: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Part by part: integers and pivot distances of a batch's rows."""
    x = vectors.matrix(b.column(b.schema.get_field_index("v")), width)
    d = b.column(b.schema.get_field_index("dist")).flatten().to_numpy().reshape(len(x), sum(len(p) for p in pivots))
    w, ends = width // parts, np.cumsum([0, *(len(p) for p in pivots)])
    return [(x[:, k * w:(k + 1) * w], d[:, ends[k]:ends[k + 1]]) for k in range(parts)]


def learn(known: DataFrame, first: np.ndarray, pivots: list[np.ndarray], width: int, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` rounds; a round is one pass and one sum per entry and component."""
    parts, entries, w = first.shape
    books = first
    for _ in range(rounds):
        shared = known.sparkSession.sparkContext.broadcast((books, pivots))

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now, fixed = shared.value
            search = [Book(e, p) for e, p in zip(now, fixed, strict=True)]
            total = np.zeros((parts, entries, w + 1), np.int64)  # the last column counts
            for b in batches:
                if b.num_rows == 0:
                    continue
                for k, (x, d) in enumerate(_columns(b, width, parts, fixed)):
                    at = search[k].nearest(x, d)[0]
                    order = np.argsort(at, kind="stable")
                    cut = np.flatnonzero(np.concatenate([[True], at[order][1:] != at[order][:-1]]))
                    here = at[order][cut]
                    total[k, here, :w] += np.add.reduceat(x[order], cut, axis=0)
                    total[k, here, w] += np.diff(np.concatenate([cut, [len(order)]]))
            part, entry = np.nonzero(total[:, :, w])
            place = np.tile(np.arange(w + 1, dtype=np.int32), len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part, w + 1).astype(np.int32)), pa.array(np.repeat(entry, w + 1).astype(np.int32)),
                 pa.array(place), pa.array(total[part, entry].ravel(), pa.int64())], names=["part", "entry", "place", "total"])

        got = (known.select("v", "dist").mapInArrow(sums, "part int, entry int, place int, total long")
               .groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).toArrow())
        total = np.zeros((parts, entries, w + 1), np.int64)
        total[tuple(got.column(c).to_numpy() for c in ("part", "entry", "place"))] = got.column("total").to_numpy()
        count = total[:, :, w:]
        books = np.where(count > 0, total[:, :, :w] // np.maximum(count, 1), books)
        shared.unpersist()
    return books


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 1024,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error) of every kept row, final codebooks by part, entry and place); at most 256 entries."""
    rows = stage(df.where(vectors.whole(vec_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vectors.integers(vec_col, scale).alias("v")), "codes-rows")
    width = -(-vectors.width_of(rows) // parts) * parts
    first = first_entries(rows, width, entries, parts)
    fixed = [vectors.far_apart(book, pivots) for book in first]
    w = width // parts

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = vectors.matrix(b.column(2), width)
            d = np.concatenate([vectors.distances(x[:, k * w:(k + 1) * w], p) for k, p in enumerate(fixed)], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, vectors.list_column(d, pa.float64())], names=["id", "label", "v", "dist"])

    kind = rows.schema["label"].dataType.simpleString()
    known = stage(rows.mapInArrow(table, f"id long, label {kind}, v array<long>, dist array<double>"), "codes-table")
    discard(rows)
    books = learn(known, first, fixed, width, rounds)
    shared = df.sparkSession.sparkContext.broadcast((books, fixed))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, to = shared.value
        search = [Book(e, p) for e, p in zip(now, to, strict=True)]
        for b in batches:
            if b.num_rows == 0:
                continue
            found = [search[k].nearest(x, d) for k, (x, d) in enumerate(_columns(b, width, parts, to))]
            codes = np.stack([at for at, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(sum(square for _, square in found), pa.int64())], names=["id", "label", "code", "error"])

    coded = stage(known.mapInArrow(assign, f"id long, label {kind}, code string, error long"), "codes")
    discard(known)
    return coded, books


def digest(df: DataFrame, **kw) -> DataFrame:
    """vec_id, code, error, label_error (of all rows with the row's label, nulls together), codebooks_sha256."""
    coded, books = compress(df, **kw)
    text = ",".join(map(str, books.ravel().tolist()))
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # A key of its own on both sides: the join then exchanges the rows anew and a frequent label can be split.
    key = lambda c: F.xxhash64(F.col(c), F.lit(1))
    joined = coded.join(sums, (key("label") == key("of")) & F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                         F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
