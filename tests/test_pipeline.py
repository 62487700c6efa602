"""End-to-end preparation and features on hand-built clinical tables."""

import datetime as dt

from pyspark.sql import functions as F

from icuflow.functions import dictionary as D
from icuflow.operators import clean, features, sequences
from icuflow.plans import pipeline

T = dt.datetime


def _raw(spark):
    patients = spark.createDataFrame([(1, "F", T(2060, 1, 11)), (2, "M", T(2040, 1, 1))],
                                     "subject_id long, gender string, dob timestamp")
    admissions = spark.createDataFrame([(1, 100, T(2100, 1, 1), 0), (2, 300, T(2100, 1, 1), 1)],
                                       "subject_id long, hadm_id long, admittime timestamp, hospital_expire_flag int")
    icustays = spark.createDataFrame([(1, 100, 1, T(2100, 1, 1, 10)), (2, 300, 3, T(2100, 1, 1, 10))],
                                     "subject_id long, hadm_id long, icustay_id long, intime timestamp")
    chart = spark.createDataFrame([
        (1, 100, "211", T(2100, 1, 1, 9), "80", "bpm"),            # before INTIME: kept
        (1, 100, "220045", T(2100, 1, 1, 11), "90", "bpm"),        # HR
        (1, 100, "226707", T(2100, 1, 1, 11), "70", "in"),         # HEIGHT 177.8
        (1, 100, "678", T(2100, 1, 1, 12), "98.6", "F"),           # TEMP 37
        (1, 100, "211", T(2100, 1, 1, 12), "abc", "bpm"),          # unparsable -> null, kept
        (1, 100, "211", T(2100, 1, 1, 13), None, "bpm"),           # null -> dropped
        (1, 100, "211", T(2100, 1, 2, 10), "200", "bpm"),          # exactly 24 h: out of 24 h
        (1, 100, "211", T(2100, 1, 1, 14), "10001", "bpm"),        # HR outlier
        (1, 100, "184", T(2100, 1, 1, 14), "Spontaneously", ""),   # GO = 4 (VALUEUOM empty)
        (2, 300, "211", T(2100, 1, 1, 12), "abc", "bpm"),          # only a null value
    ], "subject_id long, hadm_id long, itemid string, charttime timestamp, value string, valueuom string")
    lab = spark.createDataFrame([
        (1, None, "50931", T(2100, 1, 1, 11), "140", "mg"),         # GLU via subject, attributed to 100
        (1, 100, "51006", T(2100, 1, 1, 10), "20", "mg"),           # at INTIME: dropped
    ], "subject_id long, hadm_id long, itemid string, charttime timestamp, value string, valueuom string")
    return patients, admissions, icustays, chart, lab


def test_prepare_and_mean_features(spark):
    prep = pipeline.prepare_events(*_raw(spark), hours=24, feature_set="B")
    ev = prep.events.collect()
    assert all(r.itemid in D.FEATURES_SET_B for r in ev)
    wide = {r.hadm_id: r for r in pipeline.mean_feature_table(prep.events, prep.patients_info, "B").collect()}
    a = wide[100]
    assert a.HR == 85.0                        # mean of 80, 90 (null and outlier excluded)
    assert abs(a.HEIGHT - 177.8) < 1e-9 and abs(a.TEMP - 37.0) < 1e-9
    assert a.GO == 4.0 and a.GLU == 140.0
    assert a.FIO == 52.0 and a.UREA == 25.0    # imputed
    assert a.age == 40.0 and a.gender_01 == 0 and a.hospital_expire_flag == 0
    b = wide[300]                              # admission with only null values still has a row
    assert b.HR == 86.0 and b.gender_01 == 1 and b.hospital_expire_flag == 1


def test_sequences_end_to_end(spark):
    prep = pipeline.prepare_events(*_raw(spark), hours=24, feature_set="A")
    seqs = {r.hadm_id: r for r in pipeline.sequence_table(prep.events, prep.patients_info, 24, "A").collect()}
    assert seqs[100].num_stamps == 4            # calendar hours 09, 11, 12, 14
    assert all(len(step) == 17 for step in seqs[100].value)
    assert all(v == -1.0 or 0.0 <= v <= 1.0 for step in seqs[100].value for v in step)


def test_sequence_length_limit(spark):
    rows = [(1, f"2100-01-01 {h:02d}", float(h)) for h in range(24)] + \
           [(2, f"2100-01-{1 + h // 24:02d} {h % 24:02d}", float(h)) for h in range(31)]
    hourly = spark.createDataFrame(rows, "hadm_id long, time string, HR double")
    out = {r.hadm_id: r.num_stamps for r in sequences.build_sequences(hourly, ["HR"], 30).collect()}
    assert out == {1: 24}
    out = {r.hadm_id: r.num_stamps for r in sequences.build_sequences(hourly, ["HR"], 31).collect()}
    assert out == {1: 24, 2: 31}
    seq = sequences.build_sequences(hourly, ["HR"], 31).filter("hadm_id = 1").first().value
    assert [s[0] for s in seq] == [float(h) for h in range(24)]   # time order


def test_outliers_keep_nulls_and_union(spark):
    df = spark.createDataFrame([("HR", None), ("HR", 10001.0), ("TEMP", 20.0)], "itemid string, value double")
    assert clean.drop_outliers(df, D.OUTLIER_RULES_13).count() == 2
    u = clean.union_events(df, df.select("value", "itemid"))
    assert u.count() == 6


def test_pivot_and_impute(spark):
    df = spark.createDataFrame([(1, "HR", 80.0), (1, "HR", 90.0), (1, "GLU", None), (2, "SBP", 100.0)],
                               "hadm_id long, itemid string, value double")
    wide = {r.hadm_id: r for r in features.impute(features.pivot_means(df, D.FEATURES_SET_A),
                                                  D.IMPUTE_SET_A).collect()}
    assert wide[1].HR == 85.0 and wide[1].GLU == 128.0 and wide[2].HR == 86.0 and wide[2].SBP == 100.0
    long = features.pivot_long(features.mean_by_item(df), ["HR", "SBP"]).orderBy("hadm_id").collect()
    assert long[0].HR == 85.0 and long[1].SBP == 100.0


def _write_csv(path, header, rows):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_run_preparation_from_csv(spark, tmp_dir):
    d = f"{tmp_dir}/data"
    import os
    os.makedirs(d)
    _write_csv(f"{d}/PATIENTS.csv", ["ROW_ID", "SUBJECT_ID", "GENDER", "DOB"],
               [(1, 1, "F", "2060-01-11 00:00:00"), (2, 2, "M", "2090-01-01 00:00:00")])
    _write_csv(f"{d}/ADMISSIONS.csv", ["SUBJECT_ID", "HADM_ID", "ADMITTIME", "HOSPITAL_EXPIRE_FLAG"],
               [(1, 100, "2100-01-01 00:00:00", 0), (2, 150, "2100-01-01 00:00:00", 1)])
    _write_csv(f"{d}/ICUSTAYS.csv", ["SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "INTIME"],
               [(1, 100, 1, "2100-01-01 10:00:00"), (2, 150, 2, "2100-01-01 10:00:00")])
    _write_csv(f"{d}/CHARTEVENTS.csv", ["SUBJECT_ID", "HADM_ID", "ITEMID", "CHARTTIME", "VALUE", "VALUEUOM"],
               [(1, 100, 211, "2100-01-01 09:00:00", 80, "bpm"), (1, 100, 211, "2100-01-02 11:00:00", 82, "bpm"),
                (1, 100, 226707, "2100-01-01 11:00:00", 70, "in"), (1, 100, 211, "2100-01-01 12:00:00", "", "bpm"),
                (2, 150, 211, "2100-01-01 11:00:00", 99, "bpm")])
    _write_csv(f"{d}/LABEVENTS.csv", ["SUBJECT_ID", "HADM_ID", "ITEMID", "CHARTTIME", "VALUE", "VALUEUOM"],
               [(1, "", 50931, "2100-01-01 11:00:00", 140, "mg"), (1, 100, 51006, "2100-01-01 10:00:00", 20, "mg")])
    paths = pipeline.run_preparation(spark, d, f"{tmp_dir}/out")
    assert set(paths) == set(pipeline.OUTPUTS)
    read = lambda n: spark.read.option("header", "true").csv(paths[n])
    assert read("patientsInfo").count() == 1
    assert read("chart48Hr").count() == 4 and read("chart24Hr").count() == 3
    assert read("lab24Hr").count() == 1
    assert read("chart24").count() == 2           # empty VALUE dropped
    items = {r.ITEMID if "ITEMID" in r else r.itemid for r in read("chartLab24Item20").collect()}
    assert items == {"HR", "HEIGHT", "GLU"}


def test_hourly_one_pass_equals_means_then_pivot(spark):
    rows = [(1, 10, "HR", T(2100, 1, 1, 10, 5), 80.0), (1, 10, "HR", T(2100, 1, 1, 10, 55), 90.0),
            (1, 10, "SBP", T(2100, 1, 1, 10, 30), 120.0), (1, 10, "HR", T(2100, 1, 1, 11, 0), None),
            (2, 20, "GLU", T(2100, 1, 2, 0, 0), 140.0)]
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, itemid string, charttime timestamp, value double")
    one = sequences.hourly_features(df, D.FEATURES_SET_A)
    two = sequences.hourly_pivot(sequences.hourly_means(df), D.FEATURES_SET_A)
    assert sorted(map(tuple, one.collect()), key=lambda t: (t[0], t[1])) == \
        sorted(map(tuple, two.select(*one.columns).collect()), key=lambda t: (t[0], t[1]))
    assert one.count() == 3
