import hashlib
import math
from collections import defaultdict

import numpy as np

from icuflow.llm import vector_codes, vectors


def brute(rows, parts=4, entries=256, rounds=4):
    """{(id, code, error, label error)} and the codebooks' digest over rows of (id, vector, label)."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    w = width // parts
    kept = [(i, v + [0] * (width - len(v)), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])]
    out, sums = [], defaultdict(int)
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        sums[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label]) for i, c, e, label in out), key=str), digest


def got(df, **kw):
    rows = vector_codes.digest(df, **kw).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows), key=str), {r["codebooks_sha256"] for r in rows}


def table(spark, rows):
    """Extra columns that clash with the operator's own names."""
    return spark.createDataFrame([(i, v, label, 1, "x", 2.0) for i, v, label in rows], "vec_id long, embedding array<float>, label int, id int, code string, error double")


def test_equals_brute_force_with_copies_and_a_hot_label(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(420, 8)).astype(np.float32)
    x[100:240] = x[5]  # a third of the rows are one vector
    rows = [(7 * i - 50, x[i].tolist(), None if i % 11 == 0 else (3 if i % 3 else i % 5)) for i in range(len(x))]
    want, digest = brute(rows, entries=24)
    assert got(table(spark, rows).repartition(5), entries=24) == (want, {digest})
    want, digest = brute(rows)
    assert got(table(spark, rows)) == (want, {digest})


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -2.0, 3.0], 1), (1, [0.5, 0.0, 0.25, 1.0, 9.0], 1), (None, [2.0], None), (None, [2.0], None), (4, [], None),
            (5, None, 2), (6, [nan], 2), (7, [None], 2), (8, [inf], 2), (9, [-0.0001] * 5, 2)]
    want, digest = brute(rows)
    assert got(table(spark, rows)) == (want, {digest})
    assert vector_codes.digest(table(spark, rows).limit(0)).collect() == []
    only = [(3, [], 1)]
    assert got(table(spark, only))[0] == [(3, "00000000", 0, 0)]


def test_bounds_prune_without_changing_the_nearest_entry():
    rng = np.random.default_rng(4)
    centres = rng.integers(-900, 900, (64, 6))
    x = (centres[rng.integers(0, 64, 3000)] + rng.integers(-20, 20, (3000, 6))).astype(np.int64)
    entries = np.concatenate([centres, centres[:5], x[:40]])  # equal entries: the lower index wins
    pivots = vectors.far_apart(entries, 8)
    at, square = vector_codes.Book(entries, pivots).nearest(x, vectors.distances(x, pivots))
    all_ = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (at == all_.argmin(1)).all() and (square == all_.min(1)).all()
    low = np.abs(vectors.distances(x, pivots)[:, None] - vectors.distances(entries, pivots)[None]).max(2)
    assert (low ** 2 <= all_ + 1e-6).all() and (low ** 2 <= square[:, None]).mean() < 0.3


def test_large_components_are_exact():
    rng = np.random.default_rng(5)
    x = rng.integers(-(1 << 25), 1 << 25, (500, 6))
    entries = np.concatenate([x[:30], x[:30] + rng.integers(-2, 2, (30, 6))])
    pivots = vectors.far_apart(entries, 8)
    at, square = vector_codes.Book(entries, pivots).nearest(x, vectors.distances(x, pivots))
    all_ = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (at == all_.argmin(1)).all() and (square == all_.min(1)).all()
