"""Hourly time series and padded sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..functions.columns import feature_array, hour_key, minmax_scale, pad_array, sex_code
from .split import arithmetic_hash


def hourly_means(df: DataFrame, subject: str = "subject_id", hadm: str = "hadm_id",
                 item: str = "itemid", time_col: str = "charttime", value: str = "value",
                 hour: str = "time") -> DataFrame:
    """F10 + A5: mean per (subject, admission, item, calendar hour)."""
    per = df.groupBy(subject, hadm, item, F.date_trunc("hour", time_col).alias("_hour")).agg(F.avg(value).alias("_mean"))
    # The key is written as text once per group, not once per event.
    return per.select(subject, hadm, item, hour_key("_hour").alias(hour), F.col("_mean").alias(value))


def hourly_pivot(df: DataFrame, features: Sequence[str], hadm: str = "hadm_id", item: str = "itemid",
                 hour: str = "time", value: str = "value") -> DataFrame:
    """(admission, hour) x feature pivot of hourly means."""
    aggs = [F.first(F.when(F.col(item) == F.lit(f), F.col(value)), ignorenulls=True).alias(f)
            for f in features]
    return df.groupBy(hadm, hour).agg(*aggs)


def hourly_features(df: DataFrame, features: Sequence[str], hadm: str = "hadm_id",
                    item: str = "itemid", time_col: str = "charttime", value: str = "value",
                    hour: str = "time") -> DataFrame:
    """A5 + A6 in one aggregation: one row per (admission, hour), one mean per feature.

    Same result as hourly means followed by the pivot, with one exchange and
    map-side partial aggregation instead of two exchanges.
    """
    aggs = [F.avg(F.when(F.col(item) == F.lit(f), F.col(value))).alias(f) for f in features]
    per = df.groupBy(hadm, F.date_trunc("hour", time_col).alias("_hour")).agg(*aggs)
    return per.select(hadm, hour_key("_hour").alias(hour), *features)


def add_demographics(hourly: DataFrame, patients_info: DataFrame, hadm: str = "hadm_id",
                     age: str = "age", gender: str = "gender",
                     zero_value: str = D.SEX_ZERO_SEQUENCE, sex_out: str = "gender_num") -> DataFrame:
    """J10 + F11: repeat age and the sex code (M = 0) on every hourly row (inner join)."""
    static = patients_info.select(F.col(hadm), F.col(age).cast("double").alias(age),
                                  sex_code(gender, zero_value).alias(sex_out))
    return hourly.join(static, on=hadm, how="inner")


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Global min and max of every column in one aggregation.

    The result is one row of 2 x len(cols) numbers (a fixed-size summary, as
    with Spark ML scalers), so bringing it to the driver is bounded.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in cols}


def minmax_apply(df: DataFrame, stats: Mapping[str, tuple[float | None, float | None]],
                 fill: float | None = -1.0) -> DataFrame:
    """F13 + F14: scale to [0, 1]; constant columns and nulls become ``fill``."""
    out = df.withColumns({c: minmax_scale(c, lo, hi) for c, (lo, hi) in stats.items()})
    if fill is not None:
        out = out.na.fill(float(fill), subset=list(stats))
    return out


def step_counts(hourly: DataFrame, hadm: str = "hadm_id", out: str = "num_stamps") -> DataFrame:
    """F16 ahead of collection: number of hourly steps per admission."""
    return hourly.groupBy(hadm).agg(F.count(F.lit(1)).cast("int").alias(out))


def build_sequences(hourly: DataFrame, feature_cols: Sequence[str], max_steps: int | None,
                    hadm: str = "hadm_id", hour: str = "time", seq: str = "value",
                    length: str = "num_stamps") -> DataFrame:
    """F15 + A8 + F16 + P12: per admission the time-ordered list of feature rows.

    Admissions longer than ``max_steps`` are removed *before* rows are
    collected (a count, then a semi-join), so no group larger than
    ``max_steps`` is ever gathered into one task.  Order is made explicit
    with ``sort_array`` over (hour, row) structs (H12).
    """
    rows = hourly.select(hadm, hour, feature_array(feature_cols).alias("_row"))
    if max_steps is not None:
        keep = step_counts(hourly, hadm).filter(F.col("num_stamps") <= F.lit(max_steps)).select(hadm)
        rows = rows.join(keep, on=hadm, how="left_semi")
    collected = rows.groupBy(hadm).agg(
        F.sort_array(F.collect_list(F.struct(F.col(hour).alias("t"), F.col("_row").alias("r")))).alias("_s"))
    return collected.select(hadm, F.transform("_s", lambda s: s["r"]).alias(seq),
                            F.size("_s").cast("int").alias(length))


def pad_sequences(seqs: DataFrame, target_len: int, width: int, seq: str = "value",
                  out: str = "padded", fill: float = -1.0) -> DataFrame:
    """pad every sequence with ``fill`` rows to ``target_len`` steps."""
    return seqs.withColumn(out, pad_array(seq, target_len, width, fill))


def length_batches(seqs: DataFrame, batches: int, width: int, seed: int = 1, key: str = "hadm_id", seq: str = "value",
                   length: str = "num_stamps", fill: float = -1.0) -> DataFrame:
    """U3 + F17: batches by a hash of the key; inside each, longest first, padded to the batch's own longest.

    Adds ``batch``, ``place`` (0 = longest, ties by key), ``batch_steps`` and ``padded``.  Batches hold about
    rows / ``batches`` sequences, whatever the lengths, so no order over all rows is needed: both windows
    are over one batch.  A sequence without steps is padded throughout.
    """
    rows = seqs.withColumn("batch", F.pmod(arithmetic_hash(key, seed), F.lit(batches)).cast("int"))
    one = Window.partitionBy("batch")
    placed = rows.withColumns({
        "place": F.row_number().over(one.orderBy(F.col(length).desc(), F.col(key).asc())) - 1,
        "batch_steps": F.max(length).over(one)})
    lacking = F.array_repeat(F.array_repeat(F.lit(float(fill)), width), F.col("batch_steps") - F.coalesce(F.size(seq), F.lit(0)))
    return placed.withColumn("padded", F.concat(F.coalesce(F.col(seq), F.array().cast("array<array<double>>")), lacking))


def sequences_with_label(seqs: DataFrame, patients_info: DataFrame, hadm: str = "hadm_id",
                         label: str = "hospital_expire_flag") -> DataFrame:
    """Sequences inner-joined with the admission label."""
    return seqs.join(patients_info.select(hadm, label), on=hadm, how="inner")


def sequence_feature_columns(feature_set: str, age: str = "age", sex: str = "gender_num") -> list[str]:
    """F15 column order: features alphabetically, then age and sex code in set B."""
    cols = list(D.features_for(feature_set))
    if feature_set.upper() == "B":
        cols += [age, sex]
    return cols
