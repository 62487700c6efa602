"""Cohort selection.

Instead of collecting id lists to the driver and sending them back as IN
literals, cohort membership is a semi-join, so nothing passes through the
driver and the plan stays distributed at any cohort size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import age_years


def adult_admissions(patients: DataFrame, admissions: DataFrame, min_age: float = 18.0,
                     subject: str = "subject_id", hadm: str = "hadm_id", dob: str = "dob",
                     admittime: str = "admittime", gender: str = "gender",
                     label: str = "hospital_expire_flag", age: str = "age") -> DataFrame:
    """J1 + F4 + P5: admissions joined to their patient, aged ``>= min_age``.

    Output: subject, hadm, admittime, age, gender, label.
    """
    p = patients.select(subject, dob, gender)
    a = admissions.select(subject, hadm, admittime, label)
    joined = a.join(p, on=subject, how="inner")
    return (joined.withColumn(age, age_years(admittime, dob))
            .filter(F.col(age) >= F.lit(min_age))
            .select(subject, hadm, admittime, age, gender, label))


def single_stay_admissions(icustays: DataFrame, hadm: str = "hadm_id") -> DataFrame:
    """A1: admissions with exactly one ICU stay (group count + HAVING).

    A partial (map-side) count runs before the shuffle, so a hot admission
    costs one row per map task.
    """
    return (icustays.groupBy(hadm).agg(F.count(F.lit(1)).alias("n_stays"))
            .filter(F.col("n_stays") == 1).select(hadm))


def select_cohort(patients: DataFrame, admissions: DataFrame, icustays: DataFrame,
                  min_age: float = 18.0, subject: str = "subject_id", hadm: str = "hadm_id",
                  dob: str = "dob", admittime: str = "admittime", gender: str = "gender",
                  label: str = "hospital_expire_flag") -> DataFrame:
    """Adult admissions that have exactly one ICU stay.

    Output (patientsInfo): subject, hadm, age, gender, label.
    """
    adults = adult_admissions(patients, admissions, min_age, subject, hadm, dob, admittime,
                              gender, label)
    singles = single_stay_admissions(icustays, hadm)
    return (adults.join(singles, on=hadm, how="left_semi")
            .select(subject, hadm, "age", gender, label))


def cohort_with_start(patients: DataFrame, admissions: DataFrame, icustays: DataFrame,
                      min_age: float = 18.0, subject: str = "subject_id", hadm: str = "hadm_id",
                      intime: str = "intime", label: str = "hospital_expire_flag") -> DataFrame:
    """J2 + J3 + J5 in one pass over the stays: the cohort with its ICU start time.

    One aggregation counts an admission's stays and keeps the start time, so the
    stays are read and shuffled once.  Output: subject, hadm, age, gender, label, intime.
    """
    singles = (icustays.groupBy(hadm).agg(F.count(F.lit(1)).alias("n_stays"), F.min(intime).alias(intime))
               .filter(F.col("n_stays") == 1).select(hadm, intime))
    adults = adult_admissions(patients, admissions, min_age, subject, hadm, label=label)
    return adults.join(singles, on=hadm, how="inner").select(subject, hadm, "age", "gender", label, intime)


def distinct_subjects(df: DataFrame, subject: str = "subject_id") -> DataFrame:
    """A2: distinct subject ids."""
    return df.select(subject).distinct()


def stay_start(icustays: DataFrame, cohort: DataFrame, subject: str = "subject_id",
               hadm: str = "hadm_id", intime: str = "intime") -> DataFrame:
    """J3 + J5: ICU start time of every cohort admission.

    The cohort list is applied as a join on the admission key instead of an
    IN list of literals.  Output: subject, hadm, intime (one row per
    cohort admission, since the cohort keeps single-stay admissions).
    """
    stays = icustays.select(F.col(hadm), F.col(intime))
    return cohort.select(subject, hadm).join(stays, on=hadm, how="inner").select(subject, hadm, intime)
