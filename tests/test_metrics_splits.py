"""Metrics (M9-M13), ordered scans, splits and folds."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from icuflow.operators import metrics, profile, split
from icuflow.operators.ordered import with_prefix


def scored(spark, scores, labels):
    return spark.createDataFrame([(i, float(s), int(l)) for i, (s, l) in enumerate(zip(scores, labels))],
                                 "id long, score double, label int")


def test_auc_examples(spark):
    assert metrics.roc_auc(scored(spark, [.1, .4, .35, .8], [0, 0, 1, 1])).first().auc == 0.75
    assert metrics.roc_auc(scored(spark, [.5, .5, .5, .5], [0, 1, 0, 1])).first().auc == 0.5


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=2, max_size=40))
def test_auc_matches_pairwise_count(spark, pairs):
    scores = [p[0] for p in pairs]
    labels = [p[1] for p in pairs]
    pos = [s for s, l in pairs if l == 1]
    neg = [s for s, l in pairs if l == 0]
    got = metrics.roc_auc(scored(spark, scores, labels)).first().auc
    if not pos or not neg:
        assert got is None
        return
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_roc_points_monotone(spark):
    pts = metrics.roc_points(scored(spark, [.1, .4, .35, .8, .8], [0, 0, 1, 1, 0])).orderBy(F.desc("threshold"))
    rows = pts.collect()
    assert [r.threshold for r in rows] == [.8, .4, .35, .1]
    assert rows[-1].tpr == 1.0 and rows[-1].fpr == 1.0
    assert all(a.tp <= b.tp and a.fp <= b.fp for a, b in zip(rows, rows[1:]))


def test_confusion_absent_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 0)], "label int, prediction int")
    c = {(r.label, r.prediction): r.n for r in metrics.confusion_counts(df).collect()}
    assert c == {(0, 0): 2, (0, 1): 1, (1, 0): 0, (1, 1): 0}
    n = {(r.label, r.prediction): r.rate for r in metrics.confusion_normalised(df).collect()}
    assert abs(n[(0, 0)] - 2 / 3) < 1e-12 and n[(1, 0)] == 0.0 and n[(1, 1)] == 0.0
    assert metrics.accuracy(df).first().accuracy == 2 / 3


def test_weighted_mean(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 3.0), ("b", 2.0, 0.0)], "g string, v double, w double")
    got = {r.g: r.weighted_mean for r in metrics.weighted_mean(df, "v", "w", ["g"]).collect()}
    assert got["a"] == 2.5 and got["b"] is None


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=60), st.integers(1, 5))
def test_positions_match_pandas(spark, values, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    out = with_prefix(df, ["v", "id"], index_col="pos", num_partitions=parts).toPandas()
    out = out.sort_values("pos")
    ref = pd.DataFrame({"id": range(len(values)), "v": values}).sort_values(["v", "id"])
    assert list(out["pos"]) == list(range(len(values)))
    assert list(out["id"]) == list(ref["id"])


def test_positional_split_disjoint_complete(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "k")
    order = [split.arithmetic_hash("k", 45), F.col("k")]
    out = split.positional_split(df, order, [("test", 20), ("valid", 20), ("train", None)]).collect()
    sizes = pd.Series([r.split for r in out]).value_counts().to_dict()
    assert sizes == {"test": 20, "valid": 20, "train": 61}
    assert len({r.k for r in out}) == 101
    again = {r.k: r.split for r in split.positional_split(df, order, [("test", 20), ("valid", 20),
                                                                     ("train", None)]).collect()}
    assert again == {r.k: r.split for r in out}


def test_fraction_split_and_folds(spark):
    df = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    order = [split.arithmetic_hash("k", 45), F.col("k")]
    s = split.fraction_split(df, order, 0.2)
    assert s.filter("split = 'test'").count() == 10
    folds = split.stratified_folds(df, "label", order, 5).toPandas()
    per = folds.groupby(["label", "fold"]).size().unstack(fill_value=0)
    assert (per.max(axis=1) - per.min(axis=1) <= 1).all()       # classes spread evenly


@pytest.mark.parametrize("keys", [range(0, 101), [10**10 + i for i in range(60)], [9 * 10**18 + 7 * i for i in range(60)], [-5, 3, -(2**62), 0]])
def test_splits_by_cuts_equal_sorted_positions(spark, keys):
    """Any 64-bit key; blocks and folds equal those of the sorted (hash, key) order."""
    keys = list(keys)
    df = spark.createDataFrame([(k, i % 3 % 2) for i, k in enumerate(keys)], "k long, label int")
    order = [split.arithmetic_hash("k", 45), F.col("k")]
    ranked = [r.k for r in df.select("k", order[0].alias("h")).orderBy("h", "k").collect()]
    m = split.HASH_MODULUS
    assert ranked == sorted(keys, key=lambda k: ((k % m * split.HASH_MULTIPLIER + 45 * 12345 + 1) % m, k))
    n, part = len(keys), len(keys) // 5
    out = split.positional_split(df, order, [("a", part), ("b", part), ("c", None)], unique_order=True)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.split for r in out.collect()}
    assert got == {k: "a" if i < part else "b" if i < 2 * part else "c" for i, k in enumerate(ranked)}
    folds = {r.k: r.fold for r in split.stratified_folds(df, "label", order, 5, unique_order=True).collect()}
    label = {k: i % 3 % 2 for i, k in enumerate(keys)}
    for v in (0, 1):
        mine = [k for k in ranked if label[k] == v]
        assert [folds[k] for k in mine] == [i * 5 // len(mine) for i in range(len(mine))]
    with pytest.raises(ValueError):
        split.stratified_folds(spark.range(500).withColumnRenamed("id", "k"), "k", order, 5, unique_order=True)


def test_summary_quantiles(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    df = spark.createDataFrame([(v, -v) for v in vals], "a double, b double")
    got = {r.col_name: r for r in profile.summary(df, ["a", "b"]).collect()}
    s = pd.Series(vals)
    assert got["a"].q25 == s.quantile(.25) and got["a"].q50 == 3.0 and got["a"].q75 == s.quantile(.75)
    assert got["b"].q25 == (-s).quantile(.25) and abs(got["a"].std - s.std()) < 1e-12


def test_null_audit_and_row_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    na = {r.col_name: r.has_null for r in profile.null_audit(df).collect()}
    assert na == {"a": False, "b": True}
    rp = {r.col_name: (r.rows, r.dtype, r.non_null) for r in profile.row_profile(df).collect()}
    assert rp == {"a": (2, "bigint", 2), "b": (2, "string", 1)}


def test_stage_flow_equals_cohort_flow(spark):
    rows = [(1, 10, 5.0), (1, 10, None), (1, 11, 7.0), (2, 20, 1.0), (3, None, 2.0), (None, 30, 9.0)]
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, v double")
    stages = [("all", F.lit(True)), ("has_v", F.col("v").isNotNull()), ("big", F.col("v") > 4.0)]
    a = profile.stage_flow(df, stages).orderBy("step").collect()
    b = profile.cohort_flow([(n, df.filter(F.coalesce(c, F.lit(False)))) for n, c in stages]).orderBy("step").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


@pytest.mark.parametrize("accuracy,buckets", [(10_000, 1024), (50, 1024), (10, 2), (200, 3)])
def test_summary_quantiles_every_path(spark, monkeypatch, accuracy, buckets):
    """Tight brackets, brackets of half the table and many refining rounds all agree with pandas."""
    monkeypatch.setattr(profile, "ACCURACY", accuracy)
    monkeypatch.setattr(profile, "BUCKETS", buckets)
    rng = np.random.default_rng(7)
    a = np.concatenate([np.full(200, 5.0), rng.normal(0, 1, 300), [1e6, -1e6], 1e-9 * rng.random(100)])
    b = np.round(rng.exponential(3.0, a.size), 3)
    rows = [(float(u), None if i % 17 == 0 else float(v)) for i, (u, v) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    qs = (0.1, 0.25, 0.5, 0.75, 0.9)
    got = {r.col_name: r for r in profile.summary(df, ["a", "b"], qs).collect()}
    pdf = pd.DataFrame(rows, columns=["a", "b"])
    for c in ["a", "b"]:
        for q in qs:
            assert got[c][f"q{int(round(q * 100))}"] == pytest.approx(pdf[c].quantile(q), rel=1e-12, abs=1e-15)


def test_summary_scans_the_table_twice(spark):
    """Moments and sketch, then counts: no third scan, whatever the values."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000), np.full(1500, 2.5)])
    df = spark.createDataFrame([(float(v),) for v in x], "a double").mapInArrow(rows, "a double")
    got = profile.summary(df, ["a"], (0.01, 0.5, 0.99)).first()
    want = [float(np.sort(x)[int(q * 4499)] + (np.sort(x)[min(int(q * 4499) + 1, 4499)] - np.sort(x)[int(q * 4499)]) * (q * 4499 - int(q * 4499))) for q in (0.01, 0.5, 0.99)]
    assert [got["q1"], got["q50"], got["q99"]] == pytest.approx(want, rel=1e-12) and seen.value == 2 * len(x)


def test_summary_with_nan_and_infinite_values(spark):
    inf, nan = float("inf"), float("nan")
    xs = [-inf] * 3 + [-1.7e308, -5e-324, 0.0, 5e-324, 1e-323, 1.7e308] + [inf] * 4 + [nan] * 5 + [None] * 3
    got = profile.summary(spark.createDataFrame([(v,) for v in xs], "a double"), ["a"], tuple(k / 17 for k in range(18))).first()
    order = sorted((v for v in xs if v is not None and v == v)) + [nan] * 5
    assert got["count"] == 18 and [str(got[6 + k]) for k in range(18)] == [str(v) for v in order]


def test_bitmaps_count_as_distinct_does(spark):
    """Negative, zero, repeated and null ids, ids at the ends of a bitmap, and a third of the rows on one id."""
    ids = [-40_000, -32_768, -32_767, -1, 0, 1, 32_767, 32_768, 32_769, 65_536, 65_537, 10**12, None]
    rows = [(ids[i % len(ids)] if i % 3 else 7, i % 5, float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "hadm_id long, subject_id long, v double").repartition(6)
    stages = [("all", F.lit(True)), ("some", F.col("v") > 4), ("few", (F.col("v") > 4) & (F.col("subject_id") == 2)), ("none", F.col("v") > 99), ("null", F.lit(None).cast("boolean"))]
    a = [tuple(r) for r in profile.stage_flow(df, stages, dense=True).orderBy("step").collect()]
    assert a == [tuple(r) for r in profile.stage_flow(df, stages).orderBy("step").collect()]
    assert profile.count_distinct(df, "hadm_id", dense=True).first()[0] == len(ids) == profile.count_distinct(df, "hadm_id").first()[0]
    assert [tuple(r)[2:] for r in profile.stage_flow(df.limit(0), stages, dense=True).collect()] == [(0, 0, 0)] * 5


def test_hot_admission_of_the_flow_is_split(spark):
    """The flow's join splits an admission that holds a third of the events: no admission is tied to one task."""
    from icuflow.operators import windows
    n, keys = 60_000, ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                       "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.forceOptimizeSkewedJoin")
    keep = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keep, ("-1", "32k", "16k", "1.5", "true"), strict=True):
            spark.conf.set(k, v)
        ev = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 4000).alias("hadm_id"), F.timestamp_seconds(F.col("id")).alias("charttime"))
        stays = ev.select("hadm_id").distinct().withColumn("intime", F.timestamp_seconds(F.lit(0)))
        joined = windows.with_hours(windows.attach_stay_start(ev, stays)).withColumn("subject_id", F.col("hadm_id"))
        flow = profile.stage_flow(joined, [("all", F.lit(True)), ("early", F.col("hours") < 1)], dense=True)
        got = {r["stage"]: (r["events"], r["admissions"]) for r in flow.collect()}
        assert "skew=true" in flow._jdf.queryExecution().executedPlan().toString()
        assert got["all"] == (n, 4000) and got["early"][0] == 3600
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("buckets", [1, 7])
def test_roc_points_bucketed_match_brute_force(spark, monkeypatch, buckets):
    """Cumulative counts across quantile buckets, with tied, NaN and null scores (NaN first, null last)."""
    monkeypatch.setattr(metrics, "partitions_for", lambda rows, spark: buckets)
    rng = np.random.default_rng(3)
    scores = [float(v) for v in rng.integers(0, 60, 400)] + [float("nan"), float("nan"), None, None]
    labels = [int(v) for v in rng.integers(0, 2, len(scores))]
    df = spark.createDataFrame([(i, s, l) for i, (s, l) in enumerate(zip(scores, labels))],
                               "id long, score double, label int")
    got = {(None if r.threshold is None else ("nan" if np.isnan(r.threshold) else r.threshold)): (r.tp, r.fp)
           for r in metrics.roc_points(df).collect()}
    keys = ["nan"] + sorted({s for s in scores if s is not None and not np.isnan(s)}, reverse=True) + [None]

    def key(s):
        return None if s is None else ("nan" if np.isnan(s) else s)
    want, tp, fp = {}, 0, 0
    for k in keys:
        tp += sum(1 for s, l in zip(scores, labels) if key(s) == k and l == 1)
        fp += sum(1 for s, l in zip(scores, labels) if key(s) == k and l != 1)
        want[k] = (tp, fp)
    assert got == want
