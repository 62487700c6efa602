import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from icuflow.llm import pivot_search, vectors


def brute(rows, k=10, is_query=lambda i: i is not None and i % 100 == 0):
    """(query id, rank, id, score) over rows of (id, vector)."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(kept):
        if is_query(i):
            found = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for c, (j, w) in enumerate(kept) if c != q)[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found)]
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in pivot_search.top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect()), key=str)


def table(spark, rows):
    """Extra columns that clash with the operator's own names."""
    return spark.createDataFrame([(i, v, 1, 2, 3.0, "x") for i, v in rows], "vec_id long, embedding array<float>, row int, id int, score double, chunk string")


def clustered(n, width=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, width))
    x = (centres[rng.integers(0, 20, n)] + 0.05 * rng.normal(size=(n, width))).astype(np.float32)
    return [(i, x[i].tolist()) for i in range(n)]


def test_equals_brute_force_with_copies_ties_and_several_chunks(spark, monkeypatch):
    rows = clustered(1500)
    rows += [(2000 + i, rows[300][1]) for i in range(600)]  # a third of the rows are one vector: ties by id
    want = brute(rows)
    assert got(table(spark, rows)) == want
    monkeypatch.setattr(pivot_search, "CHUNK_BYTES", 1 << 13)
    assert got(table(spark, rows).repartition(7)) == want
    assert got(table(spark, rows), k=3, pivots=2, sample=0) == brute(rows, 3)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [-1.0]), (200, []), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (300, [inf, 0.0]),
            (None, [5.0, 5.0]), (None, [5.0, 5.0]), (5, [0.0005, -0.0005]), (-100, [3.0, -4.0, 0.5])]
    assert got(table(spark, rows)) == brute(rows)
    df = table(spark, rows)
    assert pivot_search.top_k(df.limit(0)).collect() == [] and pivot_search.top_k(df.where("vec_id = 100")).collect() == []
    assert pivot_search.top_k(df, is_query=F.col("id") == 5).select("query_id").distinct().collect()[0][0] == 5
    with pytest.raises(Exception, match="too large"):
        pivot_search.top_k(table(spark, [(0, [1e6]), (1, [1.0])])).collect()


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(7)
    x = rng.integers(-60_000, 60_000, (300, 40)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert got(table(spark, rows)) == brute(rows)


def test_bounds_hold_and_stop_early():
    x = np.floor(1024 * np.array([v for _, v in clustered(4000)])).astype(np.int64)
    pivots = np.concatenate([np.zeros((1, x.shape[1]), np.int64), vectors.far_apart(x[:500], 32)])
    chunk = pivot_search.Chunk(np.arange(len(x)), np.arange(len(x)), x, vectors.distances(x, pivots))
    q = x[17]
    bound = chunk.bounds(vectors.distances(q[None], pivots)[0], float((q * q).sum()))
    true = x @ q
    assert (bound >= true).all()
    # On clustered vectors most candidates lie under the k-th best score and are never evaluated.
    assert (bound >= np.sort(true)[-11]).mean() < 0.2
