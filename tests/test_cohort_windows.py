"""Cohort, windows, interval join, CSV source (FIXTURES section 3)."""

import datetime as dt

from icuflow.operators import cohort, windows
from icuflow.sources.csv import load_csv_table, write_csv

T = dt.datetime


def _tables(spark):
    patients = spark.createDataFrame([(1, "F", T(2060, 1, 11)), (2, "M", T(2090, 1, 1)), (3, "M", T(2050, 5, 5))],
                                     "subject_id long, gender string, dob timestamp")
    admissions = spark.createDataFrame(
        [(1, 100, T(2100, 1, 1), 0), (2, 150, T(2100, 1, 1), 1), (3, 200, T(2100, 1, 1), 1),
         (1, 101, T(2100, 1, 1, 5), 1)],
        "subject_id long, hadm_id long, admittime timestamp, hospital_expire_flag int")
    icustays = spark.createDataFrame(
        [(1, 100, 1000, T(2100, 1, 1, 10)), (2, 150, 1500, T(2100, 1, 1, 10)), (3, 200, 2000, T(2100, 1, 1)),
         (3, 200, 2001, T(2100, 1, 2)), (1, 101, 1010, T(2100, 1, 1, 12))],
        "subject_id long, hadm_id long, icustay_id long, intime timestamp")
    return patients, admissions, icustays


def test_cohort_age_and_single_stay(spark):
    p, a, i = _tables(spark)
    adults = {r.hadm_id: r.age for r in cohort.adult_admissions(p, a).collect()}
    assert adults[100] == 40.0 and 150 not in adults           # under 18 dropped
    c = {r.hadm_id for r in cohort.select_cohort(p, a, i).collect()}
    assert c == {100, 101}                                      # 200 has two stays
    assert cohort.distinct_subjects(cohort.select_cohort(p, a, i)).count() == 1
    stays = cohort.stay_start(i, cohort.select_cohort(p, a, i)).collect()
    assert sorted((r.hadm_id, r.intime) for r in stays) == [(100, T(2100, 1, 1, 10)), (101, T(2100, 1, 1, 12))]


def test_open_window_and_24h_boundary(spark):
    stays = spark.createDataFrame([(100, T(2100, 1, 1, 10))], "hadm_id long, intime timestamp")
    chart = spark.createDataFrame(
        [(1, 100, "211", T(2100, 1, 1, 9), "80"), (1, 100, "211", T(2100, 1, 2, 10), "81"),
         (1, 100, "211", T(2100, 1, 2, 9, 59, 59), "82"), (1, 100, "999", T(2100, 1, 1, 11), "1")],
        "subject_id long, hadm_id long, itemid string, charttime timestamp, value string")
    w24 = {r.value for r in windows.chart_window(chart, stays, 24, ["211"]).collect()}
    w48 = {r.value for r in windows.chart_window(chart, stays, 48, ["211"]).collect()}
    assert w24 == {"80", "82"}            # before INTIME kept; exactly 24 h excluded
    assert w48 == {"80", "81", "82"}


def test_interval_join_labs(spark):
    stays = spark.createDataFrame([(1, 100, T(2100, 1, 1, 10)), (1, 101, T(2100, 1, 1, 12))],
                                  "subject_id long, hadm_id long, intime timestamp")
    labs = spark.createDataFrame(
        [(1, None, "50931", T(2100, 1, 1, 10), "5"),      # at INTIME of 100: excluded for 100
         (1, None, "50931", T(2100, 1, 1, 13), "6")],     # after both starts: two rows
        "subject_id long, hadm_id long, itemid string, charttime timestamp, value string")
    out = windows.interval_join(labs, stays, 24, key="subject_id", stay_cols=("hadm_id",))
    got = sorted((r.hadm_id, r.value) for r in out.collect())
    assert got == [(100, "5"), (100, "6"), (101, "6")] or got == [(100, "6"), (101, "6")]
    # strictness: the 10:00 lab is exactly at INTIME of 100 -> dropped; before 101 -> dropped
    assert (100, "5") not in got


def test_csv_dropmalformed_with_pruning(spark, tmp_dir):
    path = f"{tmp_dir}/PATIENTS.csv"
    with open(path, "w") as f:
        f.write("SUBJECT_ID,GENDER,DOB\n1,F,2060-01-11\n2,M\n3,M,2050-01-01,extra\n4,F,2070-01-01\n")
    df = load_csv_table(spark, path)
    assert df.count() == 2
    assert df.select("SUBJECT_ID").count() == 2
    assert spark.table("PATIENTS").count() == 2


def test_csv_write_and_read_back(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    write_csv(df, f"{tmp_dir}/out.csv", single_file=True)
    back = load_csv_table(spark, f"{tmp_dir}/out.csv", schema="k long, v string")
    assert sorted(r.k for r in back.collect()) == [1, 2]


def test_interval_join_equals_brute_force(spark):
    """Bucketed range join == all pairs filtered, including exact bucket and window edges."""
    import random
    rnd = random.Random(7)
    base = T(2100, 1, 1)
    # times on a 6-hour grid so that many differences hit 0 and exactly H
    stays = [(rnd.randint(1, 4), 100 + i, base + dt.timedelta(hours=6 * rnd.randint(0, 40))) for i in range(25)]
    labs = [(rnd.randint(1, 4), None, "x", base + dt.timedelta(hours=6 * rnd.randint(0, 44)), str(i))
            for i in range(120)]
    sdf = spark.createDataFrame(stays, "subject_id long, hadm_id long, intime timestamp")
    ldf = spark.createDataFrame(labs, "subject_id long, hadm_id long, itemid string, charttime timestamp, value string")
    for h in (24, 48, 30):
        got = sorted((r.value, r.hadm_id) for r in windows.interval_join(ldf, sdf, h).collect())
        want = sorted((v, hadm) for (k, _, _, t, v) in labs for (sk, hadm, start) in stays
                      if k == sk and 0 < (t - start).total_seconds() < h * 3600)
        assert got == want


def test_interval_join_reads_a_time_in_text_once(spark):
    labs = spark.createDataFrame([(1, "a", "2100-01-01 15:00:00"), (1, "b", None), (None, "c", "2100-01-01 15:00:00"), (1, "d", "2100-01-03 10:00:00")],
                                 "subject_id long, itemid string, charttime string")
    stays = spark.createDataFrame([(1, 100, T(2100, 1, 1, 10)), (1, 101, None)], "subject_id long, hadm_id long, intime timestamp")
    joined = windows.interval_join(labs, stays, 48)
    assert [(r.itemid, r.hadm_id, r.hours) for r in joined.collect()] == [("a", 100, 5.0)]
    assert joined.columns == ["subject_id", "itemid", "charttime", "hadm_id", "intime", "hours"]
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("unix_timestamp(charttime") == 1
