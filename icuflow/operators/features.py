"""Mean-value feature tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..functions.columns import sex_code


def mean_by_item(df: DataFrame, key: str = "hadm_id", item: str = "itemid",
                 value: str = "value") -> DataFrame:
    """A3: null-skipping mean per (key, item); all-null groups stay as null."""
    return df.groupBy(key, item).agg(F.avg(value).alias(value))


def pivot_means(df: DataFrame, features: Sequence[str], key: str = "hadm_id", item: str = "itemid",
                value: str = "value") -> DataFrame:
    """A3 + A4: one row per key with the mean of every listed feature.

    Written as one aggregation with a conditional average per feature, so
    the plan has a single exchange and partial aggregation (map-side
    combine) ahead of it: a hot key costs one buffer row per map task, not a
    third of the data in one reducer.  Items outside ``features`` are ignored;
    a key whose rows are all null still gets a row (all-null features).
    """
    aggs = [F.avg(F.when(F.col(item) == F.lit(f), F.col(value))).alias(f) for f in features]
    return df.groupBy(key).agg(*aggs)


def pivot_long(df: DataFrame, features: Sequence[str], key: str = "hadm_id", item: str = "itemid",
               value: str = "value") -> DataFrame:
    """A4 over a table that already holds one mean per (key, item)."""
    return df.groupBy(key).pivot(item, list(features)).agg(F.first(value))


def impute(df: DataFrame, constants: Mapping[str, float]) -> DataFrame:
    """constant imputation per column."""
    present = {k: float(v) for k, v in constants.items() if k in df.columns}
    return df.na.fill(present)


def static_info(patients_info: DataFrame, hadm: str = "hadm_id", age: str = "age",
                gender: str = "gender", label: str = "hospital_expire_flag",
                zero_value: str = D.SEX_ZERO_FEATURE_TABLE, sex_out: str = "gender_01") -> DataFrame:
    """per-admission age, 0/1 sex code and label."""
    return patients_info.select(F.col(hadm), F.col(age).cast("double").alias(age),
                                sex_code(gender, zero_value).alias(sex_out), F.col(label))


def feature_table(events: DataFrame, patients_info: DataFrame, feature_set: str = "A",
                  hadm: str = "hadm_id", item: str = "itemid", value: str = "value",
                  age: str = "age", gender: str = "gender", label: str = "hospital_expire_flag",
                  zero_value: str = D.SEX_ZERO_FEATURE_TABLE) -> DataFrame:
    """A3 + A4 + F12 + J7/J8: imputed mean features with the label (and demographics in B).

    ``events`` holds grouped, cleaned events (item = feature group).  Set A
    left-joins the label; set B also age and the sex code (F = 0).
    """
    feats = D.features_for(feature_set)
    wide = impute(pivot_means(events, feats, hadm, item, value), D.imputation_for(feature_set))
    static = static_info(patients_info, hadm, age, gender, label, zero_value)
    if feature_set.upper() == "A":
        static = static.select(hadm, label)
    return wide.join(static, on=hadm, how="left")


def feature_columns(feature_set: str, age: str = "age", sex: str = "gender_01") -> list[str]:
    """Model input columns, CRR..WEIGHT (+ age, sex code in set B)."""
    cols = list(D.features_for(feature_set))
    if feature_set.upper() == "B":
        cols += [age, sex]
    return cols


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature columns -> ML vector column."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)
