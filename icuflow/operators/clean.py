"""Typing and cleaning of events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import dictionary as D
from ..functions.columns import (categorical_code, outlier_flag, parse_double,
                                 parse_timestamp, unit_convert)

EVENT_COLUMNS = ("subject_id", "hadm_id", "itemid", "charttime", "value")


def drop_incomplete(df: DataFrame, cols: Sequence[str] = EVENT_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """Keep only the given columns and drop rows with any null among them; ``keep`` columns stay, null or not."""
    return df.select(*cols, *keep).na.drop(how="any", subset=list(cols))


def _as_timestamp(df: DataFrame, col: str) -> DataFrame:
    if isinstance(df.schema[col].dataType, StringType):
        return df.withColumn(col, parse_timestamp(col))
    return df


def type_chart_events(df: DataFrame, cols: Sequence[str] = EVENT_COLUMNS,
                      codes: Sequence[tuple[str, str]] = D.CATEGORY_CODES,
                      unit_rules=D.UNIT_RULES, keep: Sequence[str] = ()) -> DataFrame:
    """P9 -> F6/F7 -> F1 -> F3 -> F8 for chart events (X1, X2 as expressions).

    Nulls are dropped first, so text that cannot be parsed survives as a
    null value (as the original job does).
    """
    subject, hadm, item, time_col, value = cols
    out = drop_incomplete(df, cols, keep)
    out = out.withColumn(value, categorical_code(F.col(value).cast("string"), codes))
    out = _as_timestamp(out, time_col)
    out = out.withColumn(value, parse_double(value))
    return out.withColumn(value, unit_convert(item, value, unit_rules))


def type_lab_events(df: DataFrame, cols: Sequence[str] = EVENT_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """P9 -> F1 -> F3 for lab events (no category codes, no unit change)."""
    subject, hadm, item, time_col, value = cols
    out = drop_incomplete(df, cols, keep)
    out = _as_timestamp(out, time_col)
    return out.withColumn(value, parse_double(F.col(value).cast("string")))


def group_dictionary(spark, groups: Mapping[str, Iterable[str]] = D.ITEM_GROUPS,
                     item: str = "itemid") -> DataFrame:
    """The item -> group dictionary as a small table (one row per item id)."""
    rows = [(i, g) for g, items in groups.items() for i in items]
    return spark.createDataFrame(rows, f"{item} string, _group string")


def assign_groups(df: DataFrame, item: str = "itemid",
                  groups: Mapping[str, Iterable[str]] = D.ITEM_GROUPS, out: str | None = None) -> DataFrame:
    """Replace (or add) the item id by its feature group name.

    A left join with the dictionary table, explicitly broadcast: the table
    has a fixed number of rows (one per dictionary item, independent of the
    data), so each event costs one hash probe and no shuffle; ids outside
    the dictionary keep their own id.
    """
    dic = group_dictionary(df.sparkSession, groups, item)
    joined = df.join(F.broadcast(dic), on=item, how="left")
    grp = F.coalesce(F.col("_group"), F.col(item))
    cols = [grp.alias(out or item) if c == item else F.col(c) for c in df.columns]
    if out and out != item:
        cols.append(grp.alias(out))
        cols[df.columns.index(item)] = F.col(item)
    return joined.select(*cols)


def drop_outliers(df: DataFrame, rules: Sequence[tuple[str, str, float]] = D.OUTLIER_RULES_13,
                  group: str = "itemid", value: str = "value") -> DataFrame:
    """Drop rows a rule fires on; null values are kept (H4)."""
    return df.filter(~outlier_flag(group, value, rules))


def union_events(*frames: DataFrame) -> DataFrame:
    """Bag union of event tables with the same columns (by name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
