"""Restartable stages, the preparation job killed and taken up again, and the four cells from one plan."""

import os

import pytest
from pyspark.sql import functions as F

from icuflow.functions import dictionary as D
from icuflow.plans import clinical, pipeline
from icuflow.session import kept
from icuflow.sources import csv
from icuflow.sources.stages import Stages

SF = "/root/testdata/sf0.001"


def test_a_stage_is_built_once_and_again_when_its_input_changes(spark, tmp_dir):
    source = f"{tmp_dir}/in"
    spark.range(5).write.parquet(source)

    def job(version="1"):
        s = Stages(spark, f"{tmp_dir}/stages", version)
        s.source("in", source)
        a = s.stage("a", ["in"], lambda: spark.read.parquet(source).withColumn("x", F.col("id") * 2))
        b = s.stage("b", ["a"], lambda: a.where("x > 2"))
        return s.built, s.reused, b.count()

    assert job() == (["a", "b"], [], 3) and job() == ([], ["a", "b"], 3)
    assert job("2") == (["a", "b"], [], 3)
    spark.range(100, 102).write.mode("append").parquet(source)
    assert job("2") == (["a", "b"], [], 5)
    assert sorted(f for f in os.listdir(f"{tmp_dir}/stages") if f.endswith(".json")) == ["a.json", "b.json"]
    assert len([f for f in os.listdir(f"{tmp_dir}/stages") if os.path.isdir(f"{tmp_dir}/stages/{f}")]) == 2  # stale data are gone


def test_a_half_written_stage_does_not_count(spark, tmp_dir):
    s = Stages(spark, f"{tmp_dir}/stages")

    def broken():
        def rows(batches):
            for b in batches:
                yield b
                raise RuntimeError("lost")
        return spark.range(1000).repartition(4).mapInArrow(rows, "id long")

    with pytest.raises(Exception, match="lost"):
        s.stage("a", [], broken)
    again = Stages(spark, f"{tmp_dir}/stages")
    assert again.stage("a", [], lambda: spark.range(7)).count() == 7 and again.reused == []


def _raw_csv(spark, folder):
    for name, df in clinical.raw_tables(spark, SF).items():
        text = df.withColumn("valueuom", F.lit("u")) if name in ("chart", "lab") else df
        text = text.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind.startswith("timestamp")})
        csv.write_csv(text.toDF(*[c.upper() for c in text.columns]), f"{folder}/{pipeline.RAW_TABLES[name]}.csv")


def test_a_killed_preparation_goes_on_at_its_first_missing_stage(spark, tmp_dir, monkeypatch):
    data, resume = f"{tmp_dir}/data", f"{tmp_dir}/resume"
    _raw_csv(spark, data)
    read = lambda paths: {n: sorted(map(tuple, spark.read.option("header", "true").csv(p).collect()), key=str) for n, p in paths.items()}
    want = read(pipeline.run_preparation(spark, data, f"{tmp_dir}/whole"))
    assert set(want) == set(pipeline.OUTPUTS) and all(want.values())

    jobs = []
    init = Stages.__init__
    monkeypatch.setattr(Stages, "__init__", lambda self, *a, **k: (init(self, *a, **k), jobs.append(self))[0])
    scans = []
    stage = Stages.stage
    killed = iter(["window_lab", "output_chart24", "never"])
    until = {"name": next(killed)}

    def dying(self, name, inputs, build):
        if name == until["name"]:
            raise KeyboardInterrupt
        return stage(self, name, inputs, lambda: (scans.append(name), build())[1])

    effect = Stages.effect

    def dying_effect(self, name, inputs, target, run):
        if name == until["name"]:
            raise KeyboardInterrupt
        return effect(self, name, inputs, target, run)

    monkeypatch.setattr(Stages, "stage", dying)
    monkeypatch.setattr(Stages, "effect", dying_effect)
    for _ in range(2):
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_preparation(spark, data, f"{tmp_dir}/out", resume_dir=resume)
        until["name"] = next(killed)
    got = read(pipeline.run_preparation(spark, data, f"{tmp_dir}/out", resume_dir=resume))
    assert got == want
    # No stage was built twice over the three runs: the raw tables were scanned for each of their stages once.
    assert sorted(scans) == sorted(set(scans)) and {"cohort", "selected", "window_chart", "window_lab"} <= set(scans)
    built = [n for j in jobs for n in j.built]
    assert len(built) == len(set(built)) == 8 + len(pipeline.OUTPUTS) and "selected" in jobs[1].reused and "output_chart48" in jobs[2].reused
    assert not os.path.exists(resume)


def test_four_cells_come_from_one_scan_of_each_event_table(spark, tmp_dir):
    raw = clinical.raw_tables(spark, SF)
    for name, df in raw.items():
        df.write.parquet(f"{tmp_dir}/{name}")
    t = {name: spark.read.parquet(f"{tmp_dir}/{name}") for name in raw}
    cells = pipeline.feature_cells(**t)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    for name in ("chart", "lab"):
        assert sum("FileScan" in line and f"{tmp_dir}/{name}]" in line for line in plan.splitlines()) == 1
    with kept(cells) as cells:
        assert {(r.hours, r.feature_set) for r in cells.select("hours", "feature_set").distinct().collect()} == set(pipeline.CELLS)
        for hours, s in pipeline.CELLS:
            p = pipeline.prepare_events(**t, hours=hours, feature_set=s)
            alone = pipeline.mean_feature_table(p.events, p.patients_info, s)
            mine = cells.where((F.col("hours") == hours) & (F.col("feature_set") == s)).select(alone.columns)
            a, b = ({r["hadm_id"]: r for r in df.collect()} for df in (alone, mine))
            assert a.keys() == b.keys() and a
            for k in a:
                assert all(x == pytest.approx(y, rel=1e-12) for x, y in zip(a[k], b[k], strict=True))
    only = pipeline.feature_cells(**t, cells=[(24, "A")])
    assert only.select("feature_set").distinct().collect()[0][0] == "A" and only.where("age is not null or POTA is not null").count() == 0
    assert len(D.FEATURES_SET_B) + 6 == len(only.columns)


def test_sequences_of_the_four_cells_equal_those_made_alone(spark):
    t = clinical.raw_tables(spark, SF)
    rows = {(r.hours, r.feature_set, r.hadm_id): r for r in pipeline.sequence_cells(**t).collect()}
    for hours, s in pipeline.CELLS:
        p = pipeline.prepare_events(**t, hours=hours, feature_set=s)
        alone = {r.hadm_id: r for r in pipeline.sequence_table(p.events, p.patients_info, hours, s).collect()}
        assert alone and alone.keys() == {k[2] for k in rows if k[:2] == (hours, s)}
        for k, r in alone.items():
            got = rows[hours, s, k]
            assert (got.num_stamps, got.hospital_expire_flag) == (r.num_stamps, r.hospital_expire_flag)
            assert all(a == pytest.approx(b, rel=1e-9, abs=1e-12) for x, y in zip(got.value, r.value, strict=True) for a, b in zip(x, y, strict=True))
    empty = {n: df.limit(0) for n, df in t.items()}
    assert pipeline.sequence_cells(**empty).collect() == [] and pipeline.feature_cells(**empty).collect() == []


def test_hourly_rows_of_the_cells_are_no_wider_for_more_cells(spark, monkeypatch):
    """One set of feature columns whatever the number of cells: wider aggregations fall out of code generation."""
    t = clinical.raw_tables(spark, SF)
    seen = []
    monkeypatch.setattr(pipeline, "persist", lambda df: (seen.append(df), df)[1])

    def widest(node):
        below = node.children()
        return max([node.output().size(), *(widest(below.apply(k)) for k in range(below.size()))])

    features = []
    for cells in (pipeline.CELLS[:2], pipeline.CELLS):
        pipeline.sequence_cells(**t, cells=cells)
        features.append(pipeline.feature_cells(**t, cells=cells))
    for made in (seen, features):
        two, four = (widest(df._jdf.queryExecution().optimizedPlan()) for df in made)
        assert two == four < 2 * len(D.FEATURES_SET_B)
