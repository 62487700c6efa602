"""Exact top-k search by inner product, with pivot tables that bound every candidate.

Vectors become integers, floor(scale * x).  ``PIVOTS`` vectors far apart, and the
origin, are the pivots; each row's distances to them are computed once and staged.
For a query q and a candidate x every pivot p gives |d(q,p) - d(x,p)| <= d(q,x), and
the largest of these bounds L gives q.x <= (|q|^2 + |x|^2 - L^2) / 2.  Candidates are
evaluated in the order of that bound, in growing blocks, until the next bound lies
under the k-th best exact score: what is left cannot enter the result.

The candidates are dealt into chunks that fit in a task's memory; the queries go to
every chunk and stream past it.  A query starts with the k-th best of its scores with
a sample of ``SAMPLE`` rows (a lower limit of the true k-th best, whatever the sample),
so that a chunk returns nothing below it.  Sample and pivots decide on speed only; the
result is exact.

Defined cases: vectors that are null or hold a null or non-finite component take no part;
shorter vectors count as ended by zeros; an empty vector is the zero vector; rows are told
apart even if they repeat an id, and a query leaves out only its own row; ties go to the
smaller id, a null id last (a null id makes no query); an empty table gives an empty
result; a scaled component of 2^26 or more is an error; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icuflow.llm import vectors
from icuflow.llm.common import bounded_sample, discard, stage

PIVOTS = 32
SAMPLE = 2048
CHUNK_BYTES = 1 << 25
BLOCK = 256
NULL_LAST = (1 << 63) - 1
ROWS = "chunk int, kind int, row long, id long, v array<long>, dist array<double>, least long"
FOUND = "query_row long, query_id long, row long, id long, score long"
CANDIDATE, QUERY = 0, 1
NO_LIMIT = -(1 << 63)


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, without a limit where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NO_LIMIT, np.int64)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of ``x`` with rows of ``y`` (both doubles only if those are exact)."""
    return np.rint(x @ y.T).astype(np.int64) if x.dtype == np.float64 and y.dtype == np.float64 else x.astype(np.int64) @ y.astype(np.int64).T


class Chunk:
    """Candidates of one chunk with their pivot table."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, dist: np.ndarray):
        self.rows, self.ids, self.x = rows, ids, vectors.numeric(x)
        self.table = np.ascontiguousarray(dist.T)
        self.norms = (x.astype(np.float64) ** 2).sum(1)

    def bounds(self, dist: np.ndarray, norm: float) -> np.ndarray:
        """Upper bounds of the inner products with a query, with room for rounding."""
        low = np.abs(self.table[0] - dist[0])
        gap = np.empty_like(low)
        for column, d in zip(self.table[1:], dist[1:], strict=True):
            np.subtract(column, d, out=gap)
            np.abs(gap, out=gap)
            np.maximum(low, gap, out=low)
        both = self.norms + norm
        return (both - low * low) / 2 + 1e-9 * both + 1

    def best(self, row: int, x: np.ndarray, dist: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of up to k best candidates with scores of at least ``least``, best first."""
        bound = self.bounds(dist, float((x.astype(np.float64) ** 2).sum()))
        left = np.flatnonzero((bound >= least) & (self.rows != row))
        left = left[np.argsort(-bound[left], kind="stable")]
        at, scores = left[:0], np.zeros(0, np.int64)
        done, size = 0, BLOCK
        while done < len(left) and bound[left[done]] >= least:
            block = left[done:done + size]
            got = products(x[None], self.x[block])[0]
            enter = got >= least
            at, scores = np.concatenate([at, block[enter]]), np.concatenate([scores, got[enter]])
            order = np.lexsort((self.rows[at], self.ids[at], -scores))[:k]
            at, scores = at[order], scores[order]
            if len(scores) == k:
                least = max(least, int(scores[-1]))
            done, size = done + size, size * 2
        return at, scores


def _search(k: int, width: int):
    """Rows of one chunk after the other, candidates before queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, chunk = None, [], None
        for b in batches:
            numbers, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1]), [True]]))
            for first, last in zip(cut[:-1], cut[1:], strict=True):
                part = b.slice(first, last - first)
                if numbers[first] != number:
                    number, held, chunk = numbers[first], [], None
                rows, ids = part.column(2).to_numpy(), part.column(3).to_numpy()
                x = vectors.matrix(part.column(4), width)
                dist = part.column(5).flatten().to_numpy().reshape(len(x), -1)
                if kinds[first] == CANDIDATE:
                    held.append((rows, ids, x, dist))
                    continue
                if chunk is None:
                    if not held:
                        continue
                    chunk, held = Chunk(*(np.concatenate(c) for c in zip(*held, strict=True))), []
                least, q = part.column(6).to_numpy(), vectors.numeric(x)
                found = [chunk.best(rows[i], q[i], dist[i], int(least[i]), k) for i in range(len(rows))]
                at = np.concatenate([f[0] for f in found])
                who = np.repeat(np.arange(len(rows)), [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (rows[who], ids[who], chunk.rows[at], chunk.ids[at], np.concatenate([f[1] for f in found]))],
                    names=["query_row", "query_id", "row", "id", "score"])

    return run


def top_k(df: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024,
          is_query: Column | None = None, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query row with the other rows.

    ``is_query`` is a condition on the column ``id``; ids divisible by 100 if None."""
    spark = df.sparkSession
    is_query = (F.col("id") % 100 == 0) & (F.col("id") != NULL_LAST) if is_query is None else is_query
    rows = stage(df.where(vectors.whole(vec_col)).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_LAST)).alias("id"),
        vectors.integers(vec_col, scale).alias("v")), "search-rows")
    count, width = rows.count(), vectors.width_of(rows)
    drawn = pa.array([r["v"] for r in bounded_sample(rows, "row", sample).select("v").collect()], pa.list_(pa.int64()))
    seen = vectors.matrix(drawn, width)
    shared = spark.sparkContext.broadcast((seen, np.concatenate([np.zeros((1, width), np.int64), vectors.far_apart(seen, pivots)])))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(parts, -(-count * 8 * (width + pivots + 1) // CHUNK_BYTES))

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, to = shared.value
        for b in batches:
            x = vectors.matrix(b.column(2), width)
            wanted = b.column(3).to_numpy(zero_copy_only=False)
            least = np.full(len(x), NO_LIMIT, np.int64)
            if wanted.any() and len(near) > k:
                # One more than k: the query itself may be in the sample.
                least[wanted] = kth_best(products(vectors.numeric(x[wanted]), vectors.numeric(near)), k + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), b.column(3), vectors.list_column(vectors.distances(x, to), pa.float64()), pa.array(least, pa.int64())],
                names=["row", "id", "v", "wanted", "dist", "least"])

    known = stage(rows.select("row", "id", "v", F.coalesce(is_query, F.lit(False)).alias("wanted"))
                  .mapInArrow(table, "row long, id long, v array<long>, wanted boolean, dist array<double>, least long"), "search-table")
    discard(rows)
    names = [c.split()[0] for c in ROWS.split(", ")]
    candidates = known.withColumns({"chunk": F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int"), "kind": F.lit(CANDIDATE)}).select(names)
    queries = known.where("wanted").withColumns({"chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))), "kind": F.lit(QUERY)}).select(names)
    found = (candidates.unionByName(queries).repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind")
             .mapInArrow(_search(k, width), FOUND))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.nullif("id", F.lit(NULL_LAST)).alias("vec_id"), "score"))
