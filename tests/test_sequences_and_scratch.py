"""Length limits on windowed sequences, scratch files, session settings, folder streams, split of a hot admission."""

import os

import pytest
from pyspark.sql import functions as F

from icuflow.functions import dictionary as D
from icuflow.operators import windows
from icuflow.plans import analog as A
from icuflow.plans import pipeline
from icuflow.plans import queries as Q
from icuflow.session import remove_path, scratch_path
from icuflow.sources.csv import load_csv_table, write_csv
from icuflow.streaming import ingest

SF = "/root/testdata/sf0.01"


def test_some_admissions_exceed_the_limit_and_some_do_not(spark):
    r = Q.q_sequence_limit_audit(spark, SF).first()
    kept = Q.q_sequence_lengths(spark, SF).count()
    assert Q.SEQ_LIMIT == D.MAX_STEPS[24] == 30
    assert 0 < r["over_limit"] < r["admissions"] and kept == r["admissions"] - r["over_limit"] and r["most_steps"] > 30


def test_unknown_window_needs_a_limit(spark):
    ev = spark.createDataFrame([], "subject_id long, hadm_id long, itemid string, charttime timestamp, value double")
    info = spark.createDataFrame([], "subject_id long, hadm_id long, age double, gender string, hospital_expire_flag int")
    with pytest.raises(ValueError):
        pipeline.sequence_table(ev, info, hours=72)


def test_csv_read_leaves_the_session_as_it_was(spark):
    key = "spark.sql.csv.parser.columnPruning.enabled"
    before = spark.conf.get(key)
    path = scratch_path(spark, "csv-test")
    write_csv(spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string"), path)
    with open(os.path.join(path.replace("file:", ""), "part-extra.csv"), "w") as f:
        f.write("x,y\n3\n4,d\n")
    got = load_csv_table(spark, path, "csv_test", "x int, y string")
    assert sorted(r["x"] for r in got.select("x").collect()) == [1, 2, 4] and spark.conf.get(key) == before
    remove_path(spark, path)
    assert not os.path.exists(path.replace("file:", ""))


def test_stream_reads_a_folder_table(spark, tmp_dir):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.limit(300).repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    stream = ingest.read_event_stream(spark, f"{tmp_dir}/events.parquet", events.schema)
    out = ingest.run_available(A.chart_from_events(stream), f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert out.count() == 300


def test_hot_admission_is_split(spark):
    """A third of all events belong to one admission: the join splits it although means per admission follow."""
    n = 60_000
    keep = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                 "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        for k, v in zip(keep, ("-1", "32k", "16k", "1.5"), strict=True):
            spark.conf.set(k, v)
        ev = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 4000).alias("hadm_id"), F.lit("HR").alias("itemid"),
                                            F.timestamp_seconds(F.col("id")).alias("charttime"), F.col("id").cast("double").alias("value"))
        stays = ev.select("hadm_id").distinct().withColumn("intime", F.timestamp_seconds(F.lit(0)))
        mean = windows.attach_stay_start(ev, stays).groupBy("hadm_id").agg(F.avg("value").alias("m"), F.count("*").alias("n"))
        rows = {r["hadm_id"]: r["n"] for r in mean.collect()}
        assert "skew=true" in mean._jdf.queryExecution().executedPlan().toString()
        assert sum(rows.values()) == n and rows[7] >= n // 3
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_persisted_copies_are_released(spark):
    from pyspark import StorageLevel

    from icuflow.session import kept, persist, release_persisted
    release_persisted()
    df = spark.range(10).withColumn("x", F.col("id") * 3)
    with kept(df) as copy:
        assert copy.count() == 10 and copy.storageLevel != StorageLevel.NONE
        later = copy.where("x > 6")
    assert df.storageLevel == StorageLevel.NONE and later.count() == 7
    one = persist(spark.range(20).withColumn("y", F.col("id") + 1))
    assert one.count() == 20 and release_persisted() == 1 and one.storageLevel == StorageLevel.NONE
    result = Q.q_minmax_scaled(spark, SF)
    n = result.count()
    assert release_persisted() >= 1 and release_persisted() == 0 and result.count() == n
