"""Data profiles (A9-A14): summaries, null audits, previews, cohort flow."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import kept


# Rank error of the sketch is at most SKETCH_ROOM rows in ACCURACY (its own guarantee is one).
ACCURACY, SKETCH_ROOM = 10_000, 4
# Parts that a refining round cuts a cell into.
BUCKETS = 1024


def summary(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A10: count, mean, std (n-1), min, exact linear quantiles, max per column, in two scans of the table.

    The first scan is one aggregation: moments, and a mergeable quantile sketch whose
    values around each wanted rank bracket it.  The second counts the rows below the
    brackets and the values inside them; the ranks are settled on those counts.
    """
    probes = _probes(quantiles)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.percentile_approx(F.when(F.isnan(x), F.lit(math.inf)).otherwise(x), probes, ACCURACY).alias(f"k{i}")]
    r = df.agg(*aggs).first()
    ranks, brackets = {}, {}
    for i, c in enumerate(cols):
        n = r[f"n{i}"]
        if n:
            ranks[c] = sorted({k for q in quantiles for k in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))})
            brackets[c] = _brackets(ranks[c], n, probes, r[f"k{i}"])
    picks = order_statistics(df, ranks, brackets) if ranks else {}
    rows = []
    for i, c in enumerate(cols):
        n, vals = r[f"n{i}"], []
        for q in quantiles:
            p = q * (n - 1)
            a, b = (picks[c, math.floor(p)], picks[c, math.ceil(p)]) if n else (None, None)
            vals.append(None if a is None else a if a == b else a + (b - a) * (p - math.floor(p)))
        rows.append((c, n, r[f"m{i}"], r[f"s{i}"], r[f"lo{i}"], r[f"hi{i}"], *vals))
    names = [f"q{int(round(q * 100))}" for q in quantiles]
    # One row per column, assembled from the bounded summaries above.
    return df.sparkSession.createDataFrame(
        rows, "col_name string, count long, mean double, std double, min double, max double, "
        + ", ".join(f"{n} double" for n in names))


def _probes(quantiles: Sequence[float]) -> list[float]:
    """Shares at which the sketch is asked: around each quantile at growing distances, and both ends."""
    out = {0.0, 1.0}
    for q in quantiles:
        d = 1.0 / ACCURACY
        while d < 1:
            out |= {min(1.0, max(0.0, q + s * d)) for s in (-1, 1)}
            d *= 2
    return sorted(out)


def _brackets(ranks: Sequence[int], n: int, probes: Sequence[float], values: Sequence[float]) -> list[tuple[float, float]]:
    """Disjoint closed spans, ascending, that hold the values of the (0-based) ranks whatever the sketch's error."""
    room = SKETCH_ROOM * n / ACCURACY + 2
    spans = []
    for k in ranks:
        low = [v for p, v in zip(probes, values, strict=True) if p * n + room <= k + 1]
        high = [v for p, v in zip(probes, values, strict=True) if p * n - room >= k + 1]
        spans.append((max(low, default=-math.inf), min(high, default=math.inf)))
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


class _Cell(NamedTuple):
    """Values of one column known to hold some wanted ranks: rows of one bracket and tier between two values."""
    col: int
    region: int
    tier: int
    base: int            # rows of the column before the cell
    lo: float
    hi: float
    ranks: list[int]

    def rows(self) -> Column:
        return ((F.col("c") == self.col) & (F.col("region") == self.region) & (F.col("tier") == self.tier)
                & F.col("x").between(F.lit(self.lo), F.lit(self.hi)))


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], brackets: Mapping[str, Sequence[tuple[float, float]]]
                     ) -> dict[tuple[str, int], float]:
    """Exact k-th smallest values (0-based ranks, nulls left out, NaN last) by one scan of the table.

    The scan groups, per column, the values inside the brackets by value and all others by the
    gap that they lie in: partial counts, so a value held by a third of the rows costs a row a
    task.  What is left is a share of about ``SKETCH_ROOM / ACCURACY`` of the distinct values;
    rounds over it cut the cells that hold a wanted rank into ``BUCKETS`` parts until the
    part is one value.  A part is at most 1/BUCKETS of its cell wide, so the rounds end.
    """
    cols = list(ranks)
    x = F.col("x")

    def region(c: str) -> Column:
        y = F.when(F.isnan(c), F.lit(math.inf)).otherwise(F.col(c))  # NaN lies with the largest
        out = F.lit(2 * len(brackets[c]))
        for k, (lo, hi) in reversed(list(enumerate(brackets[c]))):
            out = F.when(y < F.lit(lo), 2 * k).when(y <= F.lit(hi), 2 * k + 1).otherwise(out)
        return out

    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = doubles.select(F.explode(F.array(*[F.struct(F.lit(i).alias("c"), region(c).alias("region"), F.col(c).alias("x"))
                                              for i, c in enumerate(cols)])).alias("r")).select("r.*").where(x.isNotNull())
    tier = F.when(F.isnan(x), 2).when(x == F.lit(math.inf), 1).when(x == F.lit(-math.inf), -1).otherwise(0)
    inside = F.col("region") % 2 == 1
    counts = (long.select("c", "region", F.when(inside, x).alias("x"), F.when(inside, tier).otherwise(0).alias("tier"))
              .groupBy("c", "region", "tier", "x").agg(F.count(F.lit(1)).alias("n")))
    result: dict[tuple[str, int], float] = {}
    with kept(counts) as counts:
        cells, run = [], dict.fromkeys(range(len(cols)), 0)
        for r in (counts.groupBy("c", "region", "tier").agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
                  .orderBy("c", "region", "tier").collect()):
            mine = [k for k in ranks[cols[r["c"]]] if run[r["c"]] <= k < run[r["c"]] + r["n"]]
            if mine:
                cells.append(_Cell(r["c"], r["region"], r["tier"], run[r["c"]], r["lo"], r["hi"], mine))
            run[r["c"]] += r["n"]
        while cells:
            for cell in cells:
                if cell.tier or cell.lo == cell.hi:
                    result.update({(cols[cell.col], k): cell.lo for k in cell.ranks})
            cells = _cut(counts, [cell for cell in cells if not cell.tier and cell.lo < cell.hi])
    return result


def _cut(counts: DataFrame, cells: Sequence[_Cell]) -> list[_Cell]:
    """The parts of the cells that hold wanted ranks, from one aggregation of at most cells x BUCKETS rows."""
    if not cells:
        return []
    which, part = None, None
    x = F.col("x")
    for j, cell in enumerate(cells):
        width = (cell.hi - cell.lo) / BUCKETS
        # A span too wide for a double is cut at zero; one too narrow to divide, into its single values.
        at = (F.when(x < 0, 0).otherwise(1) if math.isinf(width)
              else F.least(F.floor((x - F.lit(cell.lo)) / F.lit(max(width, 5e-324))), F.lit(BUCKETS)).cast("int"))
        which = F.when(cell.rows(), j) if which is None else which.when(cell.rows(), j)
        part = F.when(cell.rows(), at) if part is None else part.when(cell.rows(), at)
    got = (counts.where(F.col("tier") == 0).select(which.alias("j"), part.alias("part"), "x", "n").where("j is not null")
           .groupBy("j", "part").agg(F.sum("n").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("j", "part").collect())
    out, run = [], [cell.base for cell in cells]
    for r in got:
        cell = cells[r["j"]]
        mine = [k for k in cell.ranks if run[r["j"]] <= k < run[r["j"]] + r["n"]]
        if mine:
            out.append(_Cell(cell.col, cell.region, cell.tier, run[r["j"]], r["lo"], r["hi"], mine))
        run[r["j"]] += r["n"]
    return out


def null_audit(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, whether any value is null (one aggregation)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.bool_or(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', coalesce(n{i}, false)" for i, c in enumerate(cols))
    return row.selectExpr(f"stack({len(cols)}, {pairs}) as (col_name, has_null)")


def row_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, non-null count and type per column."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', '{types[c]}', n{i}" for i, c in enumerate(cols))
    return row.selectExpr("rows", f"stack({len(cols)}, {pairs}) as (col_name, dtype, non_null)")


def preview(df: DataFrame, order: Sequence[str], n: int = 5, tail: bool = False) -> DataFrame:
    """First (or last) n rows along a key order; the limit is the feature."""
    cols = [F.col(c).desc() if tail else F.col(c).asc() for c in order]
    return df.orderBy(*cols).limit(n)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(col).distinct()


def count_distinct(df: DataFrame, col: str, out: str = "n_distinct", dense: bool = False) -> DataFrame:
    """Number of distinct values.  ``dense``: integer ids that lie close together, counted by bitmaps."""
    return distinct_by_flags(df, col, [F.lit(True)]).select(F.col("d0").alias(out)) if dense else df.agg(F.countDistinct(col).alias(out))


def distinct_by_flags(df: DataFrame, key: str, flags: Sequence[Column]) -> DataFrame:
    """One row: for each flag k the rows (``e<k>``) and the distinct non-null keys (``d<k>``) that it marks.

    A task sets a bit per key in bitmaps of 2^15 neighbouring ids each; bitmaps are or-ed
    across tasks and their bits counted.  What is shuffled and reduced is 4 KB a range of ids,
    flag and task: no row per key, and a key that holds a third of the rows costs one bit.
    Meant for ids that are dense in their range; of scattered ids each would take a bitmap.
    """
    k = F.col("_k")
    marked = df.select(F.col(key).cast("long").alias("_k"), *[F.coalesce(f, F.lit(False)).alias(f"_f{i}") for i, f in enumerate(flags)])
    n = range(len(flags))
    ranges = (marked.groupBy(F.bitmap_bucket_number(k).alias("_range"))
              .agg(*[F.count(F.when(F.col(f"_f{i}"), 1)).alias(f"e{i}") for i in n],
                   *[F.bitmap_construct_agg(F.when(F.col(f"_f{i}"), F.bitmap_bit_position(k))).alias(f"b{i}") for i in n]))
    return ranges.agg(*[F.coalesce(F.sum(f"e{i}"), F.lit(0)).alias(f"e{i}") for i in n],
                      *[F.coalesce(F.sum(F.when(F.col("_range").isNotNull(), F.bitmap_count(f"b{i}"))), F.lit(0)).alias(f"d{i}") for i in n])


def cohort_flow(stages: Sequence[tuple[str, DataFrame]], subject: str = "subject_id",
                hadm: str = "hadm_id") -> DataFrame:
    """Events, admissions and patients per pipeline stage, unioned."""
    out = None
    for i, (name, df) in enumerate(stages):
        row = df.agg(F.count(F.lit(1)).alias("events"), F.countDistinct(hadm).alias("admissions"),
                     F.countDistinct(subject).alias("patients")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "events", "admissions", "patients")
        out = row if out is None else out.unionByName(row)
    return out


def stage_flow(df: DataFrame, stages: Sequence[tuple[str, Column]], subject: str = "subject_id",
               hadm: str = "hadm_id", dense: bool = False) -> DataFrame:
    """A14 for nested stages given as row flags over one frame.

    Two aggregations (admissions, patients) replace one pass plus two distinct counts per
    stage.  Output as ``cohort_flow``, as one lazy plan: the two one-row summaries are stacked
    and joined by stage.  ``dense``: both ids are integers close together, counted by bitmaps;
    otherwise by one row per id.
    """
    k = len(stages)
    flags = [cond for _, cond in stages]
    count = distinct_by_flags if dense else _distinct_by_groups
    a, p = count(df, hadm, flags), count(df, subject, flags)
    # Each summary is one row; stack it into one row per stage and join the
    # two k-row tables on the stage number (no driver round trip).
    quoted = [name.replace("\\", "\\\\").replace("'", "\\'") for name, _ in stages]
    names = ", ".join(f"{i}, '{name}', e{i}, d{i}" for i, name in enumerate(quoted))
    a_long = a.selectExpr(f"stack({k}, {names}) as (step, stage, events, admissions)")
    p_long = p.selectExpr(f"stack({k}, " + ", ".join(f"{i}, d{i}" for i in range(k)) + ") as (step, patients)")
    return a_long.join(F.broadcast(p_long), on="step", how="inner").select(
        F.col("step").cast("int"), "stage", F.col("events").cast("long"), F.col("admissions").cast("long"),
        F.col("patients").cast("long"))


def _distinct_by_groups(df: DataFrame, key: str, flags: Sequence[Column]) -> DataFrame:
    """As ``distinct_by_flags``, for any type of key, by one row per key."""
    marked = df.select(F.col(key).alias("_k"), *[F.coalesce(f, F.lit(False)).cast("long").alias(f"_f{i}") for i, f in enumerate(flags)])
    n = range(len(flags))
    per = marked.groupBy("_k").agg(*[F.sum(f"_f{i}").alias(f"_n{i}") for i in n])
    return per.agg(*[F.coalesce(F.sum(f"_n{i}"), F.lit(0)).alias(f"e{i}") for i in n],
                   *[F.count(F.when((F.col(f"_n{i}") > 0) & F.col("_k").isNotNull(), 1)).alias(f"d{i}") for i in n])
