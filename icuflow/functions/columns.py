"""Scalar column expressions (parsing, time arithmetic, codes, units).

Every function returns a ``Column`` built from built-in Spark functions, so
the work stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionary as D

ColumnOrName = Column | str

SECONDS_PER_YEAR = 60 * 60 * 24 * 365
SECONDS_PER_HOUR = 60 * 60


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_timestamp(col: ColumnOrName) -> Column:
    """text -> timestamp; unparsable text gives null instead of failing."""
    return F.try_to_timestamp(_c(col))


def epoch_seconds(col: ColumnOrName) -> Column:
    """timestamp (or NTZ timestamp) -> whole epoch seconds (bigint)."""
    return F.unix_timestamp(_c(col))


def parse_double(col: ColumnOrName) -> Column:
    """text -> double; unparsable text and NaN become null (H1, H4)."""
    v = _c(col).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def age_years(later: ColumnOrName, earlier: ColumnOrName, digits: int = 2) -> Column:
    """age in 365-day years rounded to ``digits`` (HALF_UP)."""
    secs = epoch_seconds(later) - epoch_seconds(earlier)
    return F.round(secs / F.lit(float(SECONDS_PER_YEAR)), digits)


def hours_between(t: ColumnOrName, start: ColumnOrName) -> Column:
    """fractional hours from ``start`` to ``t`` on whole seconds."""
    return (epoch_seconds(t) - epoch_seconds(start)) / F.lit(float(SECONDS_PER_HOUR))


def first_token(col: ColumnOrName) -> Column:
    """first space-separated token; an empty token becomes null."""
    return F.nullif(F.substring_index(_c(col), " ", 1), F.lit(""))


def categorical_code(col: ColumnOrName,
                     codes: Sequence[tuple[str, str]] = D.CATEGORY_CODES) -> Column:
    """categorical chart text -> code; otherwise its first token.

    The text -> code table is one literal map, so the expression stays small
    wherever the optimizer inlines it.
    """
    c = _c(col)
    if not codes:
        return first_token(c)
    lookup = F.create_map(*[F.lit(x) for pair in codes for x in pair])
    return F.coalesce(F.try_element_at(lookup, c), first_token(c))


def unit_convert(item: ColumnOrName, value: ColumnOrName,
                 rules: Sequence[tuple[Sequence[str], str, float | None]] = D.UNIT_RULES) -> Column:
    """F8: convert ``value`` by item id; null stays null, other items unchanged."""
    i, v = _c(item), _c(value)
    out = None
    for items, kind, factor in rules:
        if kind == "scale":
            conv = v * F.lit(factor)
        elif kind == "f_to_c":
            conv = (v - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)
        else:
            raise ValueError(f"unknown unit rule {kind!r}")
        cond = i.isin(list(items))
        out = F.when(cond, conv) if out is None else out.when(cond, conv)
    return out.otherwise(v) if out is not None else v


def item_group(item: ColumnOrName, groups: Mapping[str, Iterable[str]] = D.ITEM_GROUPS) -> Column:
    """item id -> feature group; ids outside the dictionary pass through."""
    i = _c(item)
    out = None
    for name, items in groups.items():
        cond = i.isin(list(items))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(i) if out is not None else i


def hour_key(ts: ColumnOrName) -> Column:
    """calendar-hour key ``yyyy-MM-dd HH`` (string, zone-free for NTZ)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH")


def sex_code(col: ColumnOrName, zero_value: str) -> Column:
    """``zero_value`` -> 0, anything else (null included) -> 1."""
    c = _c(col)
    return F.when(c == F.lit(zero_value), F.lit(0)).otherwise(F.lit(1))


def minmax_scale(col: ColumnOrName, lo: float | Column | None, hi: float | Column | None) -> Column:
    """(x - min) / (max - min); 0/0 and null give null (H5)."""
    c = _c(col).cast("double")
    if isinstance(lo, Column) and isinstance(hi, Column):
        return F.try_divide(c - lo, hi - lo)
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    return F.try_divide(c - F.lit(float(lo)), F.lit(float(hi)) - F.lit(float(lo)))


def feature_array(cols: Sequence[ColumnOrName]) -> Column:
    """row -> array<double> in the given column order."""
    return F.array(*[_c(c).cast("double") for c in cols])


def pad_array(seq: ColumnOrName, target_len: int, width: int, fill: float = -1.0) -> Column:
    """append rows of ``fill`` until the sequence has ``target_len`` steps."""
    s = _c(seq)
    pad_row = F.array_repeat(F.lit(float(fill)), width)
    missing = F.greatest(F.lit(target_len) - F.size(s), F.lit(0))
    return F.concat(s, F.array_repeat(pad_row, missing))


def outlier_bounds(group: ColumnOrName, rules: Sequence[tuple[str, str, float]]) -> tuple[Column, Column]:
    """Per-group (lower, upper) bound columns of a rule list; null where no rule."""
    g = _c(group)
    lower: dict[str, float] = {}
    upper: dict[str, float] = {}
    for name, op, bound in rules:
        if op == ">":
            upper[name] = min(bound, upper.get(name, bound))
        elif op == "<":
            lower[name] = max(bound, lower.get(name, bound))
        else:
            raise ValueError(f"unknown operator {op!r}")

    def case(bounds: dict[str, float]) -> Column:
        out = None
        for name, b in bounds.items():
            out = F.when(g == F.lit(name), F.lit(b)) if out is None else out.when(g == F.lit(name), F.lit(b))
        return out if out is not None else F.lit(None).cast("double")
    return case(lower), case(upper)


def outlier_flag(group: ColumnOrName, value: ColumnOrName,
                 rules: Sequence[tuple[str, str, float]]) -> Column:
    """True where a rule fires (value above its group's upper or below its lower
    bound); null values never fire (H4)."""
    v = _c(value)
    lower, upper = outlier_bounds(group, rules)
    return F.coalesce((v > upper) | (v < lower), F.lit(False))


def round6(col: ColumnOrName) -> Column:
    """Comparison-stable rounding to a binary grid of 2**-20 (about 1e-6).

    Scaling by a power of two is exact in floating point, and data with few
    decimals practically never lands exactly half-way on a binary grid, so
    two engines that sum in different orders return the same double.  (A
    decimal grid is tied exactly by, e.g., a mean of 8 two-decimal values.)
    """
    return F.floor(_c(col) * F.lit(GRID) + F.lit(0.5)) / F.lit(GRID)


GRID = 1048576.0
