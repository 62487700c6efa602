"""Pipeline properties over the driver's tables: windows nest, cleaned values obey
the outlier rules, scaled hourly values are in [0, 1] or the fill value."""

from pyspark.sql import functions as F

from icuflow.functions import dictionary as D
from icuflow.functions.columns import outlier_flag
from icuflow.operators import sequences
from icuflow.plans import queries as Q

SF = "/root/testdata/sf0.001"
KEY = ["subject_id", "hadm_id", "itemid", "charttime"]


def test_24h_window_rows_are_inside_48h(spark):
    w24 = Q.events_pipeline(spark, SF, 24, None).select(*KEY)
    w48 = Q.events_pipeline(spark, SF, 48, None).select(*KEY)
    assert w24.count() > 0
    assert w24.exceptAll(w48).count() == 0


def test_cleaned_values_obey_every_rule_or_are_null(spark):
    for rules in (D.OUTLIER_RULES_13, D.OUTLIER_RULES_15):
        cleaned = Q.events_pipeline(spark, SF, None, rules)
        assert cleaned.filter(outlier_flag("itemid", "value", rules)).count() == 0
        raw = Q.events_pipeline(spark, SF, None, None)
        # only rows that a rule flags are removed
        assert raw.count() - cleaned.count() == raw.filter(outlier_flag("itemid", "value", rules)).count()


def test_minmax_scaled_hourly_values_are_in_unit_range_or_fill(spark):
    hourly = sequences.hourly_features(Q.events_pipeline(spark, SF, None, D.OUTLIER_RULES_15), Q.FEATS_A)
    scaled = sequences.minmax_apply(hourly, sequences.minmax_fit(hourly, Q.FEATS_A))
    bad = None
    for c in Q.FEATS_A:
        cond = ~((F.col(c) == -1.0) | F.col(c).between(0.0, 1.0))
        bad = cond if bad is None else bad | cond
    assert scaled.count() > 0 and scaled.filter(bad).count() == 0
