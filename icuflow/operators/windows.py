"""Event time windows relative to the ICU start."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds, hours_between

# Epoch seconds before any time that a timestamp can hold.
LONG_AGO = -(1 << 62)


def select_items(df: DataFrame, items: Iterable[str], item: str = "itemid") -> DataFrame:
    """Keep rows whose item is in a fixed list (pushed into the scan as IN)."""
    return df.filter(F.col(item).isin(list(items)))


def attach_stay_start(events: DataFrame, stays: DataFrame, hadm: str = "hadm_id",
                      intime: str = "intime") -> DataFrame:
    """Events x ICU start time on the admission key (N:1).

    ``stays`` has one row per admission.  No broadcast is forced: its size
    grows with the cohort, so the choice is left to adaptive execution, which
    broadcasts it only when its measured size is under the threshold and
    otherwise splits skewed admissions of a sort-merge join.  A hash of the
    key is a second join key: an aggregation by admission after the join then
    exchanges its partial results anew, instead of tying an admission's
    events to one task, and so leaves adaptive execution free to split them.
    """
    s = stays.select(F.col(hadm).alias("_stay"), F.xxhash64(hadm).alias("_stay_hash"), F.col(intime).alias("_intime"))
    joined = events.drop(intime).join(s, (F.col(hadm) == F.col("_stay")) & (F.xxhash64(hadm) == F.col("_stay_hash")))
    front = [hadm, *[c for c in events.columns if c not in (hadm, intime)]]
    return joined.select(*front, F.col("_intime").alias(intime))


def with_hours(df: DataFrame, time_col: str = "charttime", start_col: str = "intime",
               out: str = "hours") -> DataFrame:
    """fractional hours since the ICU start."""
    return df.withColumn(out, hours_between(time_col, start_col))


def open_window(df: DataFrame, hours: float, hours_col: str = "hours") -> DataFrame:
    """``hours < H`` with no lower bound (events before the stay stay in)."""
    return df.filter(F.col(hours_col) < F.lit(float(hours)))


def bounded_window(df: DataFrame, hours: float, hours_col: str = "hours") -> DataFrame:
    """``0 < hours < H``, strict at both ends."""
    return df.filter((F.col(hours_col) > F.lit(0.0)) & (F.col(hours_col) < F.lit(float(hours))))


def chart_window(chart: DataFrame, stays: DataFrame, hours: float, items: Iterable[str] | None = None,
                 hadm: str = "hadm_id", item: str = "itemid", time_col: str = "charttime",
                 intime: str = "intime") -> DataFrame:
    """P6 + J4 + F5 + P7: chart events of the first ``hours`` of the stay.

    The item filter is applied before the join so it reaches the scan.
    Output keeps the chart columns plus ``intime`` and ``hours``.
    """
    ev = select_items(chart, items, item) if items is not None else chart
    return open_window(with_hours(attach_stay_start(ev, stays, hadm, intime), time_col, intime), hours)


def interval_join(labs: DataFrame, stays: DataFrame, hours: float, key: str = "subject_id",
                  time_col: str = "charttime", start_col: str = "intime",
                  stay_cols: Iterable[str] = ("hadm_id",), drop_lab_cols: Iterable[str] = ("hadm_id",),
                  hours_col: str = "hours") -> DataFrame:
    """Labs x stays on ``key`` with ``0 < seconds(time - start) < H``.

    A range join made an equi-join on (key, time bucket): buckets are ``H``
    hours wide, a lab falls in exactly one bucket, and a stay's window
    ``(start, start + H)`` touches at most two, so each stay is listed once
    per bucket it touches.  Only labs and stays of the same ``H``-hour span are
    ever paired (never all pairs of a subject), each match is produced
    exactly once, and the exact bounds are the residual condition.  A lab's
    time, which may be text, is read as a number once; a lab without a time
    counts as long before every window.  The output takes the stay's columns
    (``stay_cols``), so a lab without an admission id is still attributed, and
    a lab may match several stays.
    """
    stay_cols = list(stay_cols)
    width = int(round(hours * 3600))
    start_s = epoch_seconds(F.col(start_col))
    s = stays.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_s_{c}") for c in stay_cols],
                     F.col(start_col).alias("_start"), start_s.alias("_start_s"),
                     F.explode(F.sequence(F.floor(start_s / F.lit(width)),
                                          F.floor((start_s + F.lit(width)) / F.lit(width)))).alias("_b"))
    lab = labs.drop(*[c for c in drop_lab_cols if c in labs.columns])
    # Never null: a null check would be pushed below the projection and read the time again.
    lab = lab.withColumn("_time_s", F.coalesce(epoch_seconds(F.col(time_col)), F.lit(LONG_AGO)))
    lab = lab.withColumn("_lb", F.coalesce(F.floor(F.col("_time_s") / F.lit(width)), F.lit(LONG_AGO)))
    secs = F.col("_time_s") - F.col("_start_s")
    cond = ((lab[key] == s["_k"]) & (lab["_lb"] == s["_b"]) & (secs > F.lit(0)) & (secs < F.lit(width)))
    joined = lab.join(s, on=cond, how="inner")
    out = joined.withColumn(hours_col, secs / F.lit(3600.0))
    for c in stay_cols:
        out = out.withColumnRenamed(f"_s_{c}", c)
    return out.drop("_k", "_b", "_lb", "_time_s", "_start_s").withColumnRenamed("_start", start_col)
