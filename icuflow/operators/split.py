"""Reproducible splits (U2, M2, M14) and stratified folds (M5)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import with_prefix

HASH_MULTIPLIER = 1103515245
HASH_MODULUS = 2147483647


def arithmetic_hash(key: Column | str, seed: int) -> Column:
    """Seeded integer hash of an integral key; the same arithmetic runs in any SQL engine."""
    k = F.col(key) if isinstance(key, str) else key
    m = F.lit(HASH_MODULUS)
    # Reduced before it is multiplied: any 64-bit key fits.
    return F.pmod(F.pmod(k.cast("long"), m) * F.lit(HASH_MULTIPLIER) + F.lit(int(seed) * 12345 + 1), m)


# A hash in [0, 2^31) is located by its first 11 bits, then the next 10, then the last 10.
_SHIFTS = (20, 10, 0)
MAX_CLASSES = 100


def _cuts(df: DataFrame, h: Column, key: Column, wanted: Sequence[tuple[Column, int]]) -> list[Column]:
    """For each (rows, rank): a condition true for the first ``rank`` of those rows by (h, key).

    Each round counts rows per range of hashes (at most 2048 counts for each wanted
    rank) and narrows the range that holds the cut; no row is sorted or moved.  Rows
    that share the last hash are told apart by their key, which is unique.
    """
    base = [(rows, None, 0, rank) for rows, rank in wanted]
    above = None
    for shift in _SHIFTS:
        tag = None
        for i, (rows, prefix, _, rank) in enumerate(base):
            inside = rows if prefix is None else rows & (F.shiftright(h, above) == F.lit(prefix))
            part = F.when(inside & F.lit(rank > 0), F.lit(i))
            tag = [part] if tag is None else [*tag, part]
        counts: dict[int, dict[int, int]] = {}
        long = (df.select(F.shiftright(h, shift).alias("_b"), F.array_compact(F.array(*tag)).alias("_i"))
                .select("_b", F.explode("_i").alias("_i")))
        for r in long.groupBy("_i", "_b").agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["_i"], {})[r["_b"]] = r["n"]
        narrowed = []
        for i, (rows, prefix, _, rank) in enumerate(base):
            run = 0
            for b in sorted(counts.get(i, {})):
                if run + counts[i][b] >= rank:
                    narrowed.append((rows, b, run, rank - run))
                    break
                run += counts[i][b]
            else:
                narrowed.append((rows, prefix if rank <= 0 else 1 << 31, 0, rank))   # none, or all of them
        base, above = narrowed, shift
    out = []
    for (rows, cut, _, rank), (_, asked) in zip(base, wanted, strict=True):
        if asked <= 0 or cut is None:
            out.append(F.lit(False))
            continue
        last = df.where(rows & (h == F.lit(cut))).select(key.alias("k")).orderBy("k").limit(max(1, rank)).collect()
        tie = (h == F.lit(cut)) & (key <= F.lit(last[-1]["k"])) if last else F.lit(False)
        out.append((h < F.lit(cut)) | tie)
    return out


def positional_split(df: DataFrame, order: Sequence[Column | str], sizes: Sequence[tuple[str, int | None]],
                     out: str = "split", rows: int | None = None, unique_order: bool = False) -> DataFrame:
    """Cut a seeded random order into consecutive blocks.

    ``sizes`` is ``[(name, count), ..., (last_name, None)]``; the last block
    takes the rest.  Blocks are half-open and adjacent, so every row lands
    in exactly one block.  ``unique_order=True`` states that ``order`` ends
    in a key that is unique per row; ``order`` is then (a hash in [0, 2^31), the
    key), and the blocks are cut by counting hashes, without a sort.
    """
    if unique_order and len(order) == 2:
        h, key = (F.col(c) if isinstance(c, str) else c for c in order)
        ends, run = [], 0
        for _, count in sizes[:-1]:
            run += int(count)
            ends.append(run)
        expr = None
        for (name, _), inside in zip(sizes, _cuts(df, h, key, [(F.lit(True), e) for e in ends]), strict=False):
            expr = F.when(inside, F.lit(name)) if expr is None else expr.when(inside, F.lit(name))
        rest = F.lit(sizes[-1][0])
        return df.withColumn(out, rest if expr is None else expr.otherwise(rest))
    indexed = with_prefix(df, order, index_col="_pos", rows=rows, unique_order=unique_order)
    bounds, start = [], 0
    for name, count in sizes:
        end = None if count is None else start + int(count)
        bounds.append((name, start, end))
        if end is not None:
            start = end
    expr = None
    for name, lo, hi in bounds:
        cond = F.col("_pos") >= F.lit(lo) if hi is None else (F.col("_pos") >= lo) & (F.col("_pos") < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return indexed.withColumn(out, expr).drop("_pos")


def fraction_split(df: DataFrame, order: Sequence[Column | str], test_fraction: float = 0.2,
                   out: str = "split", unique_order: bool = False) -> DataFrame:
    """M2: exact ``ceil(fraction * n)`` test rows taken from a seeded order, rest train."""
    n = df.count()
    n_test = int(math.ceil(test_fraction * n))
    return positional_split(df, order, [("test", n_test), ("train", None)], out, rows=n,
                            unique_order=unique_order)


def stratified_folds(df: DataFrame, label: str, order: Sequence[Column | str], k: int = 5,
                     out: str = "fold", unique_order: bool = False) -> DataFrame:
    """M5: each class in k equal consecutive blocks along ``order``: fold = floor(position * k / class size).

    ``label`` must be categorical (at most ``MAX_CLASSES`` values).  Blocks are cut as in
    ``positional_split``; rows without a label are dealt by their hash.
    """
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 2).collect()
    counts = sorted((r[label], r["n"]) for r in per if r[label] is not None)
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values; folds need a categorical label")
    if unique_order and len(order) == 2:
        h, key = (F.col(c) if isinstance(c, str) else c for c in order)
        wanted = [(F.col(label) == F.lit(v), -(-j * n // k)) for v, n in counts for j in range(1, k)]
        passed = _cuts(df, h, key, wanted) if wanted else []
        fold = F.pmod(h, F.lit(k))
        for i, (v, _) in enumerate(counts):
            mine = [F.when(c, F.lit(0)).otherwise(F.lit(1)) for c in passed[i * (k - 1):(i + 1) * (k - 1)]]
            fold = F.when(F.col(label) == F.lit(v), sum(mine, F.lit(0))).otherwise(fold)
        return df.withColumn(out, fold.cast("int"))
    indexed = with_prefix(df, [F.col(label).asc_nulls_first(), *order], index_col="_pos",
                          rows=sum(n for _, n in counts), unique_order=unique_order)
    offset_expr, run = None, 0
    for value, n in counts:
        cond = F.col(label) == F.lit(value)
        offset_expr = (F.when(cond, F.lit(run)) if offset_expr is None else offset_expr.when(cond, F.lit(run)))
        run += n
    offset_expr = offset_expr.otherwise(F.lit(0)) if offset_expr is not None else F.lit(0)
    size = F.lit(1)
    for value, n in counts:
        size = F.when(F.col(label) == F.lit(value), F.lit(n)).otherwise(size)
    fold = F.floor((F.col("_pos") - offset_expr) * F.lit(k) / size)
    return indexed.withColumn(out, F.when(F.col(label).isNull(), F.pmod(F.col("_pos"), F.lit(k))).otherwise(fold).cast("int")).drop("_pos")
