"""Registered queries over the driver tables, with independent DuckDB oracles.

Each query maps the test tables onto clinical roles (``analog``) and runs
the library operators over the *whole* tables.  ``ORACLE`` holds, per query,
SQL written directly against the raw tables; double outputs are rounded the
same way on both sides (``floor(x * 2^20 + 0.5) / 2^20``, a binary grid of
about 1e-6) so that different summation orders cannot flip a comparison.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dictionary as D
from ..functions.columns import categorical_code, item_group, outlier_flag, parse_double, parse_timestamp, unit_convert
from ..operators import clean, cohort, features, metrics, profile, sequences, split, windows
from ..session import persist, scratch_path
from ..sources.csv import load_csv_table, write_csv
from ..sources.tables import table
from . import analog as A

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SEED = 45
# Sequences take the events of this window, and the length limit that belongs to it.
SEQ_HOURS = 24
SEQ_LIMIT = D.MAX_STEPS[SEQ_HOURS]


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column like ``round6`` (comparison-stable output).

    Built as one ``selectExpr`` so the driver makes a single JVM call.
    """
    exprs = [f"floor(`{f.name}` * 1048576e0 + 0.5) / 1048576e0 AS `{f.name}`"
             if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f"`{f.name}`"
             for f in df.schema.fields]
    return df.selectExpr(*exprs)


# --------------------------------------------------------------------------
# SQL building blocks (DuckDB dialect) for the oracles
# --------------------------------------------------------------------------

def r6(e: str) -> str:
    return f"floor(({e}) * 1048576e0 + 0.5) / 1048576e0"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_groups(col: str, groups) -> str:
    whens = " ".join(f"WHEN {col} IN ({', '.join(_q(i) for i in items)}) THEN {_q(g)}" for g, items in groups.items())
    return f"CASE {whens} ELSE {col} END"


def sql_units(item: str, v: str, rules) -> str:
    parts = []
    for items, kind, factor in rules:
        cond = f"{item} IN ({', '.join(_q(i) for i in items)})"
        conv = f"{v} * {factor!r}" if kind == "scale" else f"({v} - 32.0) * 5.0 / 9.0"
        parts.append(f"WHEN {cond} THEN {conv}")
    return f"CASE {' '.join(parts)} ELSE {v} END"


def sql_catcode(col: str, codes=D.CATEGORY_CODES) -> str:
    whens = " ".join(f"WHEN {col} = {_q(t)} THEN {_q(c)}" for t, c in codes)
    return f"CASE {whens} ELSE NULLIF(split_part({col}, ' ', 1), '') END"


def sql_keep(g: str, v: str, rules) -> str:
    conds = " OR ".join(f"({g} = {_q(n)} AND {v} {op} {b!r})" for n, op, b in rules)
    return f"NOT coalesce({conds}, false)"


SQL_CHART = """chart AS (
  SELECT user_id AS subject_id, user_id AS hadm_id, event_type AS itemid, ts AS charttime,
         CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN 'n/a ' || event_type
              ELSE CAST(value AS VARCHAR) END AS value
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events) e)"""

SQL_STAYS = """stays AS (SELECT user_id AS hadm_id, min(ts) AS intime FROM events GROUP BY user_id)"""

SQL_HOURS = """with_hours AS (
  SELECT c.subject_id, c.hadm_id, c.itemid, c.charttime, c.value,
         (floor(epoch(c.charttime)) - floor(epoch(s.intime))) / 3600.0 AS hours
  FROM chart c JOIN stays s ON c.hadm_id = s.hadm_id)"""


def sql_typed(src: str, name: str = "typed") -> str:
    units = sql_units("itemid", "v", A.EVENT_UNIT_RULES)
    return f"""{name} AS (
  SELECT subject_id, hadm_id, itemid, charttime, {units} AS value
  FROM (SELECT subject_id, hadm_id, itemid, charttime,
               TRY_CAST({sql_catcode('value')} AS DOUBLE) AS v
        FROM {src}
        WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND itemid IS NOT NULL
          AND charttime IS NOT NULL AND value IS NOT NULL) t)"""


def sql_grouped(src: str, name: str = "grouped") -> str:
    return f"""{name} AS (
  SELECT subject_id, hadm_id, {sql_groups('itemid', A.EVENT_ITEM_GROUPS)} AS itemid, charttime, value
  FROM {src})"""


def sql_cleaned(src: str, rules, name: str = "cleaned") -> str:
    return f"{name} AS (SELECT * FROM {src} WHERE {sql_keep('itemid', 'value', rules)})"


def sql_events_pipeline(hours: int | None, rules, upto: str = "cleaned") -> str:
    """CTE chain: chart -> (window) -> typed -> grouped -> cleaned."""
    ctes = [SQL_CHART]
    if hours is not None:
        ctes += [SQL_STAYS, SQL_HOURS, f"windowed AS (SELECT * FROM with_hours WHERE hours < {float(hours)!r})"]
        src = "windowed"
    else:
        src = "chart"
    ctes.append(sql_typed(src))
    ctes.append(sql_grouped("typed"))
    if rules is not None:
        ctes.append(sql_cleaned("grouped", rules))
    return "WITH " + ",\n".join(ctes)


SQL_INFO = """info AS (
  SELECT c_custkey AS subject_id, c_custkey AS hadm_id,
         18.0 + CAST((c_custkey * 7) % 70 AS DOUBLE) AS age,
         substr(c_mktsegment, 1, 1) AS gender,
         CAST(c_acctbal < 0.0 AS INTEGER) AS hospital_expire_flag
  FROM customer)"""

SQL_PATIENTS = """patients AS (
  SELECT c_custkey AS subject_id, substr(c_mktsegment, 1, 1) AS gender,
         make_timestamp(1930 + c_custkey % 60, 1 + c_custkey % 12, 1 + c_custkey % 28, 0, 0, 0) AS dob
  FROM customer)"""

SQL_ADMISSIONS = """admissions AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS admittime,
         CAST(o_orderstatus = 'F' AS INTEGER) AS hospital_expire_flag
  FROM orders)"""

SQL_ADULTS = """adults AS (
  SELECT * FROM (
    SELECT a.subject_id, a.hadm_id, a.admittime,
           round((floor(epoch(a.admittime)) - floor(epoch(p.dob))) / 31536000.0, 2) AS age,
           p.gender, a.hospital_expire_flag
    FROM admissions a JOIN patients p ON a.subject_id = p.subject_id) x
  WHERE age >= 18.0)"""

SQL_COHORT = """singles AS (SELECT l_orderkey AS hadm_id FROM lineitem GROUP BY l_orderkey HAVING count(*) = 1),
cohort AS (SELECT subject_id, hadm_id, age, gender, hospital_expire_flag
           FROM adults WHERE hadm_id IN (SELECT hadm_id FROM singles))"""


def sql_pivot(src: str, feats, key: str = "hadm_id", impute: dict | None = None, extra_key: str | None = None,
              rounded: bool = True) -> str:
    cols = []
    for f in feats:
        e = f"avg(CASE WHEN itemid = {_q(f)} THEN value END)"
        if impute is not None:
            e = f"coalesce({e}, {float(impute[f])!r})"
        cols.append(f"{r6(e) if rounded else e} AS {f}")
    keys = key if extra_key is None else f"{key}, {extra_key}"
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY {keys}"


# --------------------------------------------------------------------------
# Shared Spark building blocks over the analogue tables
# --------------------------------------------------------------------------

def _events(spark, d):
    return table(spark, d, "events")


def _chart(spark, d):
    return A.chart_from_events(_events(spark, d))


def _stays(spark, d):
    return A.stays_from_events(_events(spark, d))


def _typed(df: DataFrame) -> DataFrame:
    return clean.type_chart_events(df.select(*clean.EVENT_COLUMNS), clean.EVENT_COLUMNS,
                                   D.CATEGORY_CODES, A.EVENT_UNIT_RULES)


def _grouped(df: DataFrame) -> DataFrame:
    return clean.assign_groups(df, "itemid", A.EVENT_ITEM_GROUPS)


def events_pipeline(spark, d, hours: int | None, rules=D.OUTLIER_RULES_13) -> DataFrame:
    """chart -> (window of ``hours``) -> typed -> grouped -> outlier rules."""
    events = _events(spark, d)
    chart = A.chart_from_events(events)
    if hours is not None:
        chart = windows.chart_window(chart, A.stays_from_events(events), hours)
    out = _grouped(_typed(chart))
    return clean.drop_outliers(out, rules) if rules is not None else out


def _info(spark, d):
    return A.info_from_customer(table(spark, d, "customer"))


def _cohort(spark, d):
    return cohort.select_cohort(A.patients_from_customer(table(spark, d, "customer")),
                                A.admissions_from_orders(table(spark, d, "orders")),
                                A.icustays_from_lineitem(table(spark, d, "lineitem")))


FEATS_A = D.FEATURES_SET_A
FEATS_B = D.FEATURES_SET_B

# --------------------------------------------------------------------------
# Flagship: 24 h mean-feature table (A3 + A4 + F12 over the whole chain)
# --------------------------------------------------------------------------


@register("mean_features_24h", sql_events_pipeline(24, D.OUTLIER_RULES_13)
          + "\n" + sql_pivot("cleaned", FEATS_A, impute=D.IMPUTE_SET_A))
def q_mean_features_24h(spark, d):
    ev = events_pipeline(spark, d, 24, D.OUTLIER_RULES_13)
    wide = features.impute(features.pivot_means(ev, FEATS_A), D.IMPUTE_SET_A)
    return round_doubles(wide)


@register("features_with_label", sql_events_pipeline(24, D.OUTLIER_RULES_13) + ",\n" + SQL_INFO + ",\n"
          + "wide AS (" + sql_pivot("cleaned", FEATS_A, impute=D.IMPUTE_SET_A) + ")\n"
          + "SELECT w.*, i.hospital_expire_flag FROM wide w LEFT JOIN info i ON w.hadm_id = i.hadm_id")
def q_features_with_label(spark, d):
    ev = events_pipeline(spark, d, 24, D.OUTLIER_RULES_13)
    return round_doubles(features.feature_table(ev, _info(spark, d), "A"))


@register("features_48h_setB", sql_events_pipeline(48, D.OUTLIER_RULES_13) + ",\n" + SQL_INFO + ",\n"
          + "wide AS (" + sql_pivot("cleaned", FEATS_B, impute=D.IMPUTE_SET_B) + ")\n"
          + "SELECT w.*, " + r6("i.age") + " AS age, CASE WHEN i.gender = 'F' THEN 0 ELSE 1 END AS gender_01, "
          + "i.hospital_expire_flag FROM wide w LEFT JOIN info i ON w.hadm_id = i.hadm_id")
def q_features_48h_setB(spark, d):
    ev = events_pipeline(spark, d, 48, D.OUTLIER_RULES_13)
    return round_doubles(features.feature_table(ev, _info(spark, d), "B"))


@register("features_24h_setB", sql_events_pipeline(24, D.OUTLIER_RULES_13) + ",\n" + SQL_INFO + ",\n"
          + "wide AS (" + sql_pivot("cleaned", FEATS_B, impute=D.IMPUTE_SET_B) + ")\n"
          + "SELECT w.*, " + r6("i.age") + " AS age, CASE WHEN i.gender = 'F' THEN 0 ELSE 1 END AS gender_01, "
          + "i.hospital_expire_flag FROM wide w LEFT JOIN info i ON w.hadm_id = i.hadm_id")
def q_features_24h_setB(spark, d):
    ev = events_pipeline(spark, d, 24, D.OUTLIER_RULES_13)
    return round_doubles(features.feature_table(ev, _info(spark, d), "B"))


@register("features_48h_setA", sql_events_pipeline(48, D.OUTLIER_RULES_13) + ",\n" + SQL_INFO + ",\n"
          + "wide AS (" + sql_pivot("cleaned", FEATS_A, impute=D.IMPUTE_SET_A) + ")\n"
          + "SELECT w.*, i.hospital_expire_flag FROM wide w LEFT JOIN info i ON w.hadm_id = i.hadm_id")
def q_features_48h_setA(spark, d):
    ev = events_pipeline(spark, d, 48, D.OUTLIER_RULES_13)
    return round_doubles(features.feature_table(ev, _info(spark, d), "A"))


@register("feature_vector", sql_events_pipeline(24, D.OUTLIER_RULES_13) + ",\n" + SQL_INFO + ",\n"
          + "wide AS (" + sql_pivot("cleaned", FEATS_B, impute=D.IMPUTE_SET_B) + "),\n"
          + "inputs AS (SELECT w.hadm_id, [" + ", ".join(f"w.{f}" for f in FEATS_B) + f", {r6('i.age')}, CASE WHEN i.gender = 'F' THEN 0 ELSE 1 END] AS v "
          + "FROM wide w JOIN info i ON w.hadm_id = i.hadm_id)\n"
          + "SELECT hadm_id, CAST(k AS INTEGER) AS position, v[k + 1] AS value FROM inputs, range(len(v)) r(k)")
def q_feature_vector(spark, d):
    """The model input vector of every admission, place by place."""
    from pyspark.ml.functions import vector_to_array
    ev = events_pipeline(spark, d, 24, D.OUTLIER_RULES_13)
    wide = features.feature_table(ev, _info(spark, d), "B")
    vectors = features.assemble(wide, features.feature_columns("B"))
    return round_doubles(vectors.select("hadm_id", F.posexplode(vector_to_array("features")).alias("position", "value")))


# --------------------------------------------------------------------------
# Sources (S1-S7)
# --------------------------------------------------------------------------

@register("scan_csv_roundtrip", "SELECT * FROM customer")
def q_scan_csv_roundtrip(spark, d):
    cust = table(spark, d, "customer")
    path = scratch_path(spark, "roundtrip") + "/customer_csv.csv"
    write_csv(cust, path)
    return load_csv_table(spark, path, schema=cust.schema)


@register("sql_view_projection", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def q_sql_view_projection(spark, d):
    table(spark, d, "customer").createOrReplaceTempView("icuflow_customer")
    return spark.sql("SELECT c_custkey, c_name, c_nationkey FROM icuflow_customer")


@register("csv_view_by_file_name", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'")
def q_csv_view_by_file_name(spark, d):
    """An untyped CSV read under the view name of its file, its times parsed from text."""
    path = scratch_path(spark, "views") + "/icuflow_orders.csv"
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderstatus")
    write_csv(orders, path)
    load_csv_table(spark, path)
    view = spark.sql("SELECT o_orderkey, o_custkey, o_orderdate FROM icuflow_orders WHERE o_orderstatus = 'F'")
    return view.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"),
                       parse_timestamp("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))


# --------------------------------------------------------------------------
# Cohort (P5, F4, A1, A2, J1-J3, J5)
# --------------------------------------------------------------------------

@register("age_at_event", f"WITH {SQL_PATIENTS},\n{SQL_ADMISSIONS},\n{SQL_ADULTS}\nSELECT * FROM adults")
def q_age_at_event(spark, d):
    return cohort.adult_admissions(A.patients_from_customer(table(spark, d, "customer")),
                                   A.admissions_from_orders(table(spark, d, "orders")))


@register("single_stay_cohort",
          f"WITH {SQL_PATIENTS},\n{SQL_ADMISSIONS},\n{SQL_ADULTS},\n{SQL_COHORT}\nSELECT * FROM cohort")
def q_single_stay_cohort(spark, d):
    return _cohort(spark, d)


@register("distinct_subjects",
          f"WITH {SQL_PATIENTS},\n{SQL_ADMISSIONS},\n{SQL_ADULTS},\n{SQL_COHORT}\n"
          "SELECT DISTINCT subject_id FROM cohort")
def q_distinct_subjects(spark, d):
    return cohort.distinct_subjects(_cohort(spark, d))


@register("semi_join_filter",
          f"WITH {SQL_PATIENTS},\n{SQL_ADMISSIONS},\n{SQL_ADULTS},\n{SQL_COHORT}\n"
          "SELECT c.subject_id, c.hadm_id, l.l_shipdate AS intime FROM cohort c "
          "JOIN lineitem l ON c.hadm_id = l.l_orderkey")
def q_semi_join_filter(spark, d):
    return cohort.stay_start(A.icustays_from_lineitem(table(spark, d, "lineitem")), _cohort(spark, d))


# --------------------------------------------------------------------------
# Windows and joins
# --------------------------------------------------------------------------

_SEL = ", ".join(_q(i) for i in A.EVENT_SELECTED_ITEMS)


@register("item_in_list", f"WITH {SQL_CHART}\nSELECT * FROM chart WHERE itemid IN ({_SEL})")
def q_item_in_list(spark, d):
    return windows.select_items(_chart(spark, d), A.EVENT_SELECTED_ITEMS)


def _window_sql(cond: str) -> str:
    return (f"WITH {SQL_CHART},\n{SQL_STAYS},\n{SQL_HOURS}\n"
            f"SELECT subject_id, hadm_id, itemid, charttime, value, {r6('hours')} AS hours "
            f"FROM with_hours WHERE {cond}")


def _window_out(df: DataFrame) -> DataFrame:
    return round_doubles(df.select("subject_id", "hadm_id", "itemid", "charttime", "value", "hours"))


@register("window_open_24h", _window_sql("hours < 24.0"))
def q_window_open_24h(spark, d):
    return _window_out(windows.chart_window(_chart(spark, d), _stays(spark, d), 24))


@register("window_open_48h", _window_sql("hours < 48.0"))
def q_window_open_48h(spark, d):
    return _window_out(windows.chart_window(_chart(spark, d), _stays(spark, d), 48))


@register("window_bounded", _window_sql("hours > 0.0 AND hours < 48.0"))
def q_window_bounded(spark, d):
    joined = windows.with_hours(windows.attach_stay_start(_chart(spark, d), _stays(spark, d)))
    return _window_out(windows.bounded_window(joined, 48))


LAB_HOURS = 30 * 24

SQL_LAB_JOIN = f"""lab_joined AS (
  SELECT l.l_orderkey AS subject_id, o.o_orderkey AS hadm_id, l.l_returnflag AS itemid,
         l.l_shipdate AS charttime, CAST(l.l_quantity AS VARCHAR) AS value, o.o_orderdate AS intime,
         (floor(epoch(l.l_shipdate)) - floor(epoch(o.o_orderdate))) / 3600.0 AS hours
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE floor(epoch(l.l_shipdate)) - floor(epoch(o.o_orderdate)) > 0
    AND floor(epoch(l.l_shipdate)) - floor(epoch(o.o_orderdate)) < {LAB_HOURS * 3600})"""


def _lab_join(spark, d):
    return windows.interval_join(A.labs_from_lineitem(table(spark, d, "lineitem")),
                                 A.stays_from_orders(table(spark, d, "orders")), LAB_HOURS,
                                 key="subject_id", stay_cols=("hadm_id",))


@register("interval_join_labs",
          f"WITH {SQL_LAB_JOIN}\nSELECT subject_id, hadm_id, itemid, charttime, value, intime, "
          f"{r6('hours')} AS hours FROM lab_joined")
def q_interval_join_labs(spark, d):
    return round_doubles(_lab_join(spark, d).select("subject_id", "hadm_id", "itemid", "charttime", "value",
                                                    "intime", "hours"))


@register("union_sources",
          f"WITH {SQL_CHART},\n{SQL_STAYS},\n{SQL_HOURS},\n"
          "windowed AS (SELECT * FROM with_hours WHERE hours < 24.0),\n" + sql_typed("windowed") + ",\n"
          + SQL_LAB_JOIN + ",\n"
          "lab_typed AS (SELECT subject_id, hadm_id, itemid, charttime, TRY_CAST(value AS DOUBLE) AS value "
          "FROM lab_joined WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND itemid IS NOT NULL "
          "AND charttime IS NOT NULL AND value IS NOT NULL)\n"
          f"SELECT subject_id, hadm_id, itemid, charttime, {r6('value')} AS value FROM typed "
          f"UNION ALL SELECT subject_id, hadm_id, itemid, charttime, {r6('value')} AS value FROM lab_typed")
def q_union_sources(spark, d):
    chart = _typed(windows.chart_window(_chart(spark, d), _stays(spark, d), 24))
    labs = clean.type_lab_events(_lab_join(spark, d).select(*clean.EVENT_COLUMNS))
    return round_doubles(clean.union_events(chart, labs))


# --------------------------------------------------------------------------
# Cleaning expressions
# --------------------------------------------------------------------------

@register("drop_null_then_parse",
          f"WITH {SQL_CHART}\nSELECT subject_id, hadm_id, itemid, charttime, "
          f"{r6('TRY_CAST(value AS DOUBLE)')} AS value FROM chart "
          "WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND itemid IS NOT NULL "
          "AND charttime IS NOT NULL AND value IS NOT NULL")
def q_drop_null_then_parse(spark, d):
    return round_doubles(clean.type_lab_events(_chart(spark, d)))


@register("categorical_code",
          f"SELECT o_orderkey, o_orderpriority, {sql_catcode('o_orderpriority')} AS code, "
          f"TRY_CAST({sql_catcode('o_orderpriority')} AS DOUBLE) AS value FROM orders")
def q_categorical_code(spark, d):
    o = table(spark, d, "orders")
    code = categorical_code("o_orderpriority")
    return o.select("o_orderkey", "o_orderpriority", code.alias("code"), parse_double(code).alias("value"))


@register("unit_convert",
          f"SELECT event_id, event_type, {r6('value')} AS value, "
          f"{r6(sql_units('event_type', 'value', A.EVENT_UNIT_RULES))} AS converted FROM events")
def q_unit_convert(spark, d):
    ev = _events(spark, d)
    return round_doubles(ev.select("event_id", "event_type", "value",
                                   unit_convert("event_type", "value", A.EVENT_UNIT_RULES).alias("converted")))


@register("item_group",
          f"SELECT event_id, event_type, {sql_groups('event_type', A.EVENT_ITEM_GROUPS)} AS item_group "
          "FROM events")
def q_item_group(spark, d):
    ev = _events(spark, d)
    return ev.select("event_id", "event_type", item_group("event_type", A.EVENT_ITEM_GROUPS).alias("item_group"))


def _cleaned_sql(rules) -> str:
    return (sql_events_pipeline(None, rules) + "\n"
            f"SELECT subject_id, hadm_id, itemid, charttime, {r6('value')} AS value FROM cleaned")


@register("outlier_rules_13", _cleaned_sql(D.OUTLIER_RULES_13))
def q_outlier_rules_13(spark, d):
    return round_doubles(events_pipeline(spark, d, None, D.OUTLIER_RULES_13))


@register("outlier_rules_15", _cleaned_sql(D.OUTLIER_RULES_15))
def q_outlier_rules_15(spark, d):
    return round_doubles(events_pipeline(spark, d, None, D.OUTLIER_RULES_15))


# --------------------------------------------------------------------------
# Aggregations (A3, A5, A6, A7) and sequences
# --------------------------------------------------------------------------

@register("mean_by_item", sql_events_pipeline(None, D.OUTLIER_RULES_13) + "\n"
          f"SELECT hadm_id, itemid, {r6('avg(value)')} AS value FROM cleaned GROUP BY hadm_id, itemid")
def q_mean_by_item(spark, d):
    return round_doubles(features.mean_by_item(events_pipeline(spark, d, None, D.OUTLIER_RULES_13)))


@register("hourly_mean", sql_events_pipeline(None, D.OUTLIER_RULES_15) + "\n"
          "SELECT subject_id, hadm_id, itemid, strftime(charttime, '%Y-%m-%d %H') AS time, "
          f"{r6('avg(value)')} AS value FROM cleaned GROUP BY subject_id, hadm_id, itemid, time")
def q_hourly_mean(spark, d):
    return round_doubles(sequences.hourly_means(events_pipeline(spark, d, None, D.OUTLIER_RULES_15)))


SQL_LATE_STAYS = """stays AS (SELECT user_id AS hadm_id, min(ts) + INTERVAL 14 DAY AS intime FROM events GROUP BY user_id)"""


def sql_late_pipeline(hours: int) -> str:
    """As ``sql_events_pipeline``, with the stay 14 days after the first event."""
    return sql_events_pipeline(hours, D.OUTLIER_RULES_15).replace(SQL_STAYS, SQL_LATE_STAYS)


def late_events_pipeline(spark, d, hours: int, rules=D.OUTLIER_RULES_15) -> DataFrame:
    events = _events(spark, d)
    chart = windows.chart_window(A.chart_from_events(events), A.late_stays_from_events(events), hours)
    out = _grouped(_typed(chart))
    return clean.drop_outliers(out, rules) if rules is not None else out


SQL_HOURLY_A = (sql_late_pipeline(SEQ_HOURS) + ",\n"
                "hourly_in AS (SELECT hadm_id, strftime(charttime, '%Y-%m-%d %H') AS time, itemid, value "
                "FROM cleaned),\n"
                "hourly_raw AS (SELECT hadm_id, time, "
                + ", ".join(f"avg(CASE WHEN itemid = {_q(f)} THEN value END) AS {f}" for f in FEATS_A)
                + " FROM hourly_in GROUP BY hadm_id, time)")


@register("hourly_pivot", SQL_HOURLY_A + "\nSELECT hadm_id, time, "
          + ", ".join(f"{r6(f)} AS {f}" for f in FEATS_A) + " FROM hourly_raw")
def q_hourly_pivot(spark, d):
    return round_doubles(sequences.hourly_features(late_events_pipeline(spark, d, SEQ_HOURS), FEATS_A))


def sql_minmax(src: str, cols, name: str = "scaled", keep: str = "hadm_id, time") -> str:
    stats = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in cols)
    scaled = ", ".join(
        f"coalesce(CASE WHEN mx_{c} = mn_{c} THEN NULL ELSE ({c} - mn_{c}) / (mx_{c} - mn_{c}) END, -1.0) AS {c}"
        for c in cols)
    return (f"mm_stats AS (SELECT {stats} FROM {src}),\n"
            f"{name} AS (SELECT {keep}, {scaled} FROM {src}, mm_stats)")


@register("minmax_scaled", SQL_HOURLY_A + ",\n" + sql_minmax("hourly_raw", FEATS_A) + "\nSELECT hadm_id, time, "
          + ", ".join(f"{r6(f)} AS {f}" for f in FEATS_A) + " FROM scaled")
def q_minmax_scaled(spark, d):
    hourly = persist(sequences.hourly_features(late_events_pipeline(spark, d, SEQ_HOURS), FEATS_A))
    return round_doubles(sequences.minmax_apply(hourly, sequences.minmax_fit(hourly, FEATS_A)))


def _scaled_seq_input(spark, d, feature_set: str) -> tuple[DataFrame, list[str]]:
    ev = late_events_pipeline(spark, d, SEQ_HOURS)
    feats = D.features_for(feature_set)
    hourly = sequences.hourly_features(ev, feats)
    if feature_set == "B":
        hourly = sequences.add_demographics(hourly, _info(spark, d))
    hourly = persist(hourly)   # read by the scaler fit and by the scaling
    cols = sequences.sequence_feature_columns(feature_set)
    return sequences.minmax_apply(hourly, sequences.minmax_fit(hourly, cols)), cols


def _row_sum_sql(cols) -> str:
    return " + ".join(cols)


SQL_SEQ_A = (SQL_HOURLY_A + ",\n" + sql_minmax("hourly_raw", FEATS_A) + ",\n"
             f"kept AS (SELECT hadm_id, CAST(count(*) AS INTEGER) AS num_stamps FROM scaled GROUP BY hadm_id "
             f"HAVING count(*) <= {SEQ_LIMIT})")


@register("sequence_lengths", SQL_SEQ_A + "\nSELECT s.hadm_id, k.num_stamps, "
          f"{r6('sum(' + _row_sum_sql(FEATS_A) + ')')} AS value_sum "
          "FROM scaled s JOIN kept k ON s.hadm_id = k.hadm_id GROUP BY s.hadm_id, k.num_stamps")
def q_sequence_lengths(spark, d):
    scaled, cols = _scaled_seq_input(spark, d, "A")
    seqs = sequences.build_sequences(scaled, cols, SEQ_LIMIT)
    total = F.aggregate(F.flatten("value"), F.lit(0.0), lambda acc, x: acc + x)
    return round_doubles(seqs.select("hadm_id", "num_stamps", total.alias("value_sum")))


@register("padded_sequence", SQL_SEQ_A + ",\n"
          "ranked AS (SELECT s.*, CAST(row_number() OVER (PARTITION BY s.hadm_id ORDER BY s.time) - 1 AS INTEGER) "
          "AS step FROM scaled s JOIN kept k ON s.hadm_id = k.hadm_id),\n"
          "long_rows AS (" + " UNION ALL ".join(
              f"SELECT hadm_id, step, {i} AS feature, {r6(f)} AS value FROM ranked" for i, f in enumerate(FEATS_A))
          + "),\n"
          f"grid AS (SELECT k.hadm_id, CAST(g.step AS INTEGER) AS step, CAST(f.feature AS INTEGER) AS feature "
          f"FROM kept k, range(0, {SEQ_LIMIT}) g(step), range(0, {len(FEATS_A)}) f(feature))\n"
          "SELECT g.hadm_id, g.step, g.feature, coalesce(l.value, -1.0) AS value FROM grid g "
          "LEFT JOIN long_rows l ON g.hadm_id = l.hadm_id AND g.step = l.step AND g.feature = l.feature")
def q_padded_sequence(spark, d):
    scaled, cols = _scaled_seq_input(spark, d, "A")
    seqs = sequences.pad_sequences(sequences.build_sequences(scaled, cols, SEQ_LIMIT), SEQ_LIMIT, len(cols))
    steps = seqs.select("hadm_id", F.posexplode("padded").alias("step", "row"))
    cells = steps.select("hadm_id", "step", F.posexplode("row").alias("feature", "value"))
    return round_doubles(cells.select("hadm_id", F.col("step").cast("int"), F.col("feature").cast("int"), "value"))


@register("sequence_limit_audit", SQL_HOURLY_A + ",\n"
          f"n AS (SELECT hadm_id, count(*) AS steps FROM hourly_raw GROUP BY hadm_id)\n"
          f"SELECT count(*) AS admissions, count(*) FILTER (WHERE steps > {SEQ_LIMIT}) AS over_limit, max(steps) AS most_steps FROM n")
def q_sequence_limit_audit(spark, d):
    """How many admissions the length limit removes."""
    steps = sequences.step_counts(sequences.hourly_features(late_events_pipeline(spark, d, SEQ_HOURS), FEATS_A))
    return steps.agg(F.count(F.lit(1)).alias("admissions"), F.count_if(F.col("num_stamps") > SEQ_LIMIT).alias("over_limit"),
                     F.max("num_stamps").cast("long").alias("most_steps"))


SQL_HOURLY_B = (sql_late_pipeline(SEQ_HOURS) + ",\n" + SQL_INFO + ",\n"
                "hourly_in AS (SELECT hadm_id, strftime(charttime, '%Y-%m-%d %H') AS time, itemid, value "
                "FROM cleaned),\n"
                "hourly_b0 AS (SELECT hadm_id, time, "
                + ", ".join(f"avg(CASE WHEN itemid = {_q(f)} THEN value END) AS {f}" for f in FEATS_B)
                + " FROM hourly_in GROUP BY hadm_id, time),\n"
                "hourly_b AS (SELECT h.*, i.age AS age, CASE WHEN i.gender = 'M' THEN 0 ELSE 1 END AS gender_num "
                "FROM hourly_b0 h JOIN info i ON h.hadm_id = i.hadm_id)")
COLS_B_SEQ = FEATS_B + ["age", "gender_num"]


@register("sequence_label_join", SQL_HOURLY_B + ",\n" + sql_minmax("hourly_b", COLS_B_SEQ) + ",\n"
          f"kept AS (SELECT hadm_id, CAST(count(*) AS INTEGER) AS num_stamps, "
          f"sum({_row_sum_sql(COLS_B_SEQ)}) AS vs FROM scaled GROUP BY hadm_id HAVING count(*) <= {SEQ_LIMIT})\n"
          f"SELECT k.hadm_id, k.num_stamps, {r6('k.vs')} AS value_sum, i.hospital_expire_flag "
          "FROM kept k JOIN info i ON k.hadm_id = i.hadm_id")
def q_sequence_label_join(spark, d):
    scaled, cols = _scaled_seq_input(spark, d, "B")
    seqs = sequences.build_sequences(scaled, cols, SEQ_LIMIT)
    labelled = sequences.sequences_with_label(seqs, _info(spark, d))
    total = F.aggregate(F.flatten("value"), F.lit(0.0), lambda acc, x: acc + x)
    return round_doubles(labelled.select("hadm_id", "num_stamps", total.alias("value_sum"),
                                         "hospital_expire_flag"))


def _pipeline_seq_sql(hours: int, limit: int) -> str:
    feats = ", ".join(f"avg(CASE WHEN itemid = {_q(f)} THEN value END) AS {f}" for f in FEATS_A)
    return (sql_late_pipeline(hours) + ",\n" + SQL_INFO + ",\n"
            "hourly_in AS (SELECT hadm_id, strftime(charttime, '%Y-%m-%d %H') AS time, itemid, value FROM cleaned),\n"
            f"hourly_w AS (SELECT hadm_id, time, {feats} FROM hourly_in GROUP BY hadm_id, time),\n"
            + sql_minmax("hourly_w", FEATS_A) + ",\n"
            f"kept AS (SELECT hadm_id, CAST(count(*) AS INTEGER) AS num_stamps, sum({_row_sum_sql(FEATS_A)}) AS vs "
            f"FROM scaled GROUP BY hadm_id HAVING count(*) <= {limit})\n"
            f"SELECT k.hadm_id, k.num_stamps, {r6('k.vs')} AS value_sum, i.hospital_expire_flag "
            "FROM kept k JOIN info i ON k.hadm_id = i.hadm_id")


@register("pipeline_sequences_24h_A", _pipeline_seq_sql(24, D.MAX_STEPS[24]))
def q_pipeline_sequences_24h_A(spark, d):
    from . import pipeline
    ev = late_events_pipeline(spark, d, 24, None)
    seqs = pipeline.sequence_table(ev, _info(spark, d), hours=24, feature_set="A")
    total = F.aggregate(F.flatten("value"), F.lit(0.0), lambda acc, x: acc + x)
    return round_doubles(seqs.select("hadm_id", "num_stamps", total.alias("value_sum"), "hospital_expire_flag"))


# --------------------------------------------------------------------------
# Scaling and splits (M1, M2, U2, M14, M5 folds)
# --------------------------------------------------------------------------

def standard_scale(df: DataFrame, cols) -> DataFrame:
    from ..operators.models import standard_scaler_fit, standard_scaler_apply
    return standard_scaler_apply(df, standard_scaler_fit(df, cols))


@register("standard_scaled", sql_events_pipeline(24, D.OUTLIER_RULES_13) + ",\n"
          "wide AS (" + sql_pivot("cleaned", FEATS_A, impute=D.IMPUTE_SET_A, rounded=False) + "),\n"
          "st AS (SELECT " + ", ".join(f"avg({f}) AS mu_{f}, stddev_pop({f}) AS sd_{f}" for f in FEATS_A)
          + " FROM wide)\nSELECT hadm_id, " + ", ".join(
              r6(f"CASE WHEN sd_{f} <= 1e-12 * greatest(1.0, abs(mu_{f})) THEN 0.0 ELSE ({f} - mu_{f}) / sd_{f} END")
              + f" AS {f}" for f in FEATS_A) + " FROM wide, st")
def q_standard_scaled(spark, d):
    ev = events_pipeline(spark, d, 24, D.OUTLIER_RULES_13)
    wide = persist(features.impute(features.pivot_means(ev, FEATS_A), D.IMPUTE_SET_A))
    return round_doubles(standard_scale(wide, FEATS_A))


def sql_hash(key: str, seed: int) -> str:
    m = split.HASH_MODULUS
    return f"(((({key} % {m}) + {m}) % {m}) * {split.HASH_MULTIPLIER} + {seed * 12345 + 1}) % {m}"


@register("split_80_20",
          f"WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY {sql_hash('c_custkey', SEED)}, c_custkey) - 1 "
          "AS pos, count(*) OVER () AS n FROM customer)\n"
          "SELECT c_custkey, CASE WHEN pos < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r")
def q_split_80_20(spark, d):
    cust = table(spark, d, "customer").select("c_custkey")
    return split.fraction_split(cust, [split.arithmetic_hash("c_custkey", SEED), F.col("c_custkey")], 0.2,
                                unique_order=True)      # c_custkey is the table's key


@register("split_3way",
          f"WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY {sql_hash('c_custkey', SEED)}, c_custkey) - 1 "
          "AS pos, count(*) OVER () AS n FROM customer)\n"
          "SELECT c_custkey, CASE WHEN pos < floor(0.15 * n) THEN 'test' "
          "WHEN pos < 2 * floor(0.15 * n) THEN 'valid' ELSE 'train' END AS split FROM r")
def q_split_3way(spark, d):
    cust = table(spark, d, "customer").select("c_custkey")
    n = cust.count()
    part = int(math.floor(0.15 * n))
    return split.positional_split(cust, [split.arithmetic_hash("c_custkey", SEED), F.col("c_custkey")],
                                  [("test", part), ("valid", part), ("train", None)], rows=n,
                                  unique_order=True)


@register("stratified_folds",
          "WITH c AS (SELECT c_custkey, CAST(c_acctbal < 0.0 AS INTEGER) AS label FROM customer)\n"
          f"SELECT c_custkey, label, CAST((row_number() OVER (PARTITION BY label ORDER BY "
          f"{sql_hash('c_custkey', SEED)}, c_custkey) - 1) * 5 // count(*) OVER (PARTITION BY label) AS INTEGER) AS fold FROM c")
def q_stratified_folds(spark, d):
    cust = table(spark, d, "customer").select("c_custkey", (F.col("c_acctbal") < 0.0).cast("int").alias("label"))
    return split.stratified_folds(cust, "label", [split.arithmetic_hash("c_custkey", SEED), F.col("c_custkey")], 5,
                                  unique_order=True)


# --------------------------------------------------------------------------
# Profiles (A9-A14, A15)
# --------------------------------------------------------------------------

PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("profile_summary", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, count({c}) AS count, {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS std, "
    f"{r6(f'min({c})')} AS min, {r6(f'max({c})')} AS max, {r6(f'quantile_cont({c}, 0.25)')} AS q25, "
    f"{r6(f'quantile_cont({c}, 0.5)')} AS q50, {r6(f'quantile_cont({c}, 0.75)')} AS q75 FROM lineitem"
    for c in PROFILE_COLS))
def q_profile_summary(spark, d):
    return round_doubles(profile.summary(table(spark, d, "lineitem"), PROFILE_COLS))


@register("null_audit", SQL_HOURLY_A + "\nSELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, bool_or({c} IS NULL) AS has_null FROM hourly_raw"
    for c in ["hadm_id", "time"] + FEATS_A) + ") t")
def q_null_audit(spark, d):
    hourly = sequences.hourly_features(late_events_pipeline(spark, d, SEQ_HOURS), FEATS_A)
    return profile.null_audit(hourly)


_ROW_TYPES = [("subject_id", "bigint"), ("hadm_id", "bigint"), ("itemid", "string"),
              ("charttime", "timestamp_ntz"), ("value", "string")]


@register("row_profile", f"WITH {SQL_CHART}\n" + "\nUNION ALL\n".join(
    f"SELECT count(*) AS rows, '{c}' AS col_name, '{t}' AS dtype, count({c}) AS non_null FROM chart"
    for c, t in _ROW_TYPES))
def q_row_profile(spark, d):
    return profile.row_profile(_chart(spark, d))


@register("preview",
          "(SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 5) UNION ALL "
          "(SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 5)")
def q_preview(spark, d):
    ev = _events(spark, d).select("event_id", "user_id", "event_type", "value")
    return profile.preview(ev, ["event_id"], 5).unionByName(profile.preview(ev, ["event_id"], 5, tail=True))


@register("distinct_items", sql_events_pipeline(None, D.OUTLIER_RULES_13) + "\nSELECT DISTINCT itemid FROM cleaned")
def q_distinct_items(spark, d):
    return profile.distinct_values(events_pipeline(spark, d, None, D.OUTLIER_RULES_13), "itemid")


@register("count_distinct_admissions", sql_events_pipeline(24, D.OUTLIER_RULES_13) + "\n"
          "SELECT count(DISTINCT hadm_id) AS n_distinct FROM cleaned")
def q_count_distinct_admissions(spark, d):
    return profile.count_distinct(events_pipeline(spark, d, 24, D.OUTLIER_RULES_13), "hadm_id", dense=True)


def _flow_sql() -> str:
    head = (f"WITH {SQL_CHART},\n{SQL_STAYS},\n{SQL_HOURS},\n"
            "w48 AS (SELECT * FROM with_hours WHERE hours < 48.0),\n"
            "w24 AS (SELECT * FROM with_hours WHERE hours < 24.0),\n"
            + sql_typed("w24") + ",\n" + sql_grouped("typed") + ",\n" + sql_cleaned("grouped", D.OUTLIER_RULES_13))
    stages = [("chart", "chart"), ("window_48h", "w48"), ("window_24h", "w24"), ("typed_24h", "typed"),
              ("cleaned_24h", "cleaned")]
    body = "\nUNION ALL\n".join(
        f"SELECT {i} AS step, '{n}' AS stage, count(*) AS events, count(DISTINCT hadm_id) AS admissions, "
        f"count(DISTINCT subject_id) AS patients FROM {t}" for i, (n, t) in enumerate(stages))
    return head + "\n" + body


@register("cohort_flow", _flow_sql())
def q_cohort_flow(spark, d):
    """Events / admissions / patients after each preparation stage (single pass of flags, bitmaps of the dense ids)."""
    events = _events(spark, d)
    chart = A.chart_from_events(events)
    stays = A.stays_from_events(events).select("hadm_id", "intime")
    # The key's hash is a second join key: the counts then exchange anew and a hot admission can be split.
    stays = stays.select(F.col("hadm_id").alias("_stay"), F.xxhash64("hadm_id").alias("_hash"), "intime")
    joined = windows.with_hours(chart.join(stays, (F.col("hadm_id") == F.col("_stay")) & (F.xxhash64("hadm_id") == F.col("_hash")), "left"))
    complete = F.lit(True)
    for c in clean.EVENT_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    value = unit_convert("itemid", parse_double(categorical_code("value")), A.EVENT_UNIT_RULES)
    grouped = clean.assign_groups(joined.withColumn("_v", value), "itemid", A.EVENT_ITEM_GROUPS, out="_g")
    in24 = F.col("hours") < 24.0
    kept = in24 & F.col("_complete") & ~outlier_flag("_g", "_v", D.OUTLIER_RULES_13)
    return profile.stage_flow(grouped.withColumn("_complete", complete),
                              [("chart", F.lit(True)), ("window_48h", F.col("hours") < 48.0),
                               ("window_24h", in24), ("typed_24h", in24 & F.col("_complete")),
                               ("cleaned_24h", kept)], dense=True)


@register("weighted_mean",
          f"SELECT l_returnflag, {r6('sum(l_extendedprice * l_quantity) / sum(l_quantity)')} AS weighted_mean, "
          f"{r6('sum(l_quantity)')} AS weight_sum FROM lineitem GROUP BY l_returnflag")
def q_weighted_mean(spark, d):
    li = table(spark, d, "lineitem")
    return round_doubles(metrics.weighted_mean(li, "l_extendedprice", "l_quantity", ["l_returnflag"]))


# --------------------------------------------------------------------------
# Metrics (M9-M13) on labels x documents
# --------------------------------------------------------------------------

SQL_SCORED = """scored AS (
  SELECT l.doc_id, l.quality AS label, CAST(d.n_chars > 2000 AS INTEGER) AS prediction, d.n_chars AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _scored(spark, d):
    lab = table(spark, d, "labels")
    doc = table(spark, d, "documents").select("doc_id", "n_chars")
    return lab.join(doc, on="doc_id", how="inner").select(
        "doc_id", F.col("quality").alias("label"), (F.col("n_chars") > 2000).cast("int").alias("prediction"),
        F.col("n_chars").alias("score"))


@register("accuracy", f"WITH {SQL_SCORED}\nSELECT count(*) AS n, CAST(sum(CAST(label = prediction AS BIGINT)) "
          f"AS BIGINT) AS correct, {r6('avg(CAST(label = prediction AS DOUBLE))')} AS accuracy FROM scored")
def q_accuracy(spark, d):
    return round_doubles(metrics.accuracy(_scored(spark, d)))


SQL_GRID = "grid AS (SELECT a.x AS label, b.x AS prediction FROM (VALUES (0), (1)) a(x), (VALUES (0), (1)) b(x))"


@register("confusion_counts", f"WITH {SQL_SCORED},\n{SQL_GRID}\n"
          "SELECT g.label, g.prediction, count(s.doc_id) AS n FROM grid g LEFT JOIN scored s "
          "ON s.label = g.label AND s.prediction = g.prediction GROUP BY g.label, g.prediction")
def q_confusion_counts(spark, d):
    return metrics.confusion_counts(_scored(spark, d))


@register("confusion_normalised", f"WITH {SQL_SCORED},\n{SQL_GRID},\n"
          "c AS (SELECT g.label, g.prediction, count(s.doc_id) AS n FROM grid g LEFT JOIN scored s "
          "ON s.label = g.label AND s.prediction = g.prediction GROUP BY g.label, g.prediction)\n"
          "SELECT label, prediction, " + r6("coalesce(CAST(n AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY label), 0), 0.0)")
          + " AS rate FROM c")
def q_confusion_normalised(spark, d):
    return round_doubles(metrics.confusion_normalised(_scored(spark, d)))


SQL_ROC = f"""{SQL_SCORED},
per AS (SELECT score AS threshold, CAST(sum(CAST(label = 1 AS BIGINT)) AS BIGINT) AS pos,
               CAST(sum(CAST(label <> 1 AS BIGINT)) AS BIGINT) AS neg FROM scored GROUP BY score),
cum AS (SELECT threshold, pos, neg,
               CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
               CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
               sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per)"""


@register("roc_points", f"WITH {SQL_ROC}\nSELECT threshold, tp, fp, {r6('tp / CAST(p AS DOUBLE)')} AS tpr, "
          f"{r6('fp / CAST(n AS DOUBLE)')} AS fpr, pos, neg FROM cum")
def q_roc_points(spark, d):
    return round_doubles(metrics.roc_points(_scored(spark, d)))


@register("roc_auc_rank", f"WITH {SQL_ROC}\nSELECT "
          + r6("sum(CAST(neg AS DOUBLE) * (2.0 * tp - pos)) / (2.0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE))")
          + " AS auc, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives FROM cum")
def q_roc_auc_rank(spark, d):
    return round_doubles(metrics.roc_auc(_scored(spark, d)))


# --------------------------------------------------------------------------
# Streaming form of the preparation (file stream over the events table)
# --------------------------------------------------------------------------

@register("stream_clean_24h", sql_events_pipeline(24, D.OUTLIER_RULES_13) + "\n"
          f"SELECT subject_id, hadm_id, itemid, charttime, {r6('value')} AS value FROM cleaned")
def q_stream_clean_24h(spark, d):
    from ..streaming import ingest
    events = _events(spark, d)
    stream = ingest.read_event_stream(spark, f"{d.rstrip('/')}/events.parquet", events.schema)
    cleaned = ingest.clean_event_stream(A.chart_from_events(stream), A.stays_from_events(events), 24,
                                        groups=A.EVENT_ITEM_GROUPS, unit_rules=A.EVENT_UNIT_RULES)
    base = scratch_path(spark, "stream-clean")
    out = ingest.run_available(cleaned, f"{base}/data", f"{base}/checkpoint")
    return round_doubles(out.select(*clean.EVENT_COLUMNS))


def queries() -> dict[str, Query]:
    from . import clinical, model_queries  # noqa: F401  (they register their queries)
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLE)
