"""The whole preparation on real item ids: ``prepare_events`` from patients to features and sequences.

The driver's tables take the clinical roles as follows; the oracle SQL states the
same mapping and every constant by hand, not through ``dictionary``.

* customers are patients, orders admissions, order lines ICU stays (an order of one
  line is a single stay); all stays start within 20 hours, so a patient's stays overlap;
* an event is a chart event of its user's first single-stay order.  Its item id runs
  through all 106 chart ids and 3 unknown ones; its time is compressed 24 times, from
  the stay start on; items of the coma scale and refill carry the 18 texts;
* an order line is a lab of its customer, with one of the 13 lab ids or 2 unknown ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..session import remove_path, scratch_path
from ..sources.csv import load_csv_table, write_csv
from ..sources.tables import table
from . import analog as A
from . import pipeline
from . import queries as Q

START = "2000-01-01"
UNKNOWN_CHART, UNKNOWN_LAB = ["999001", "999002", "999003"], ["998001", "998002"]
TEXT_GROUPS = ("CRR", "GO", "GMR", "GT", "GVR")


def raw_tables(spark, d) -> dict:
    """The five raw tables in clinical roles."""
    orders, lines, events = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "events")
    start = F.lit(START).cast("timestamp_ntz")
    hours = lambda c: F.make_dt_interval(F.lit(0), c.cast("int"))
    singles = lines.groupBy(F.col("l_orderkey").alias("hadm_id")).agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("hadm_id")
    users = (orders.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id")).join(singles, "hadm_id", "left_semi")
             .groupBy("subject_id").agg(F.min("hadm_id").alias("hadm_id")))
    first = events.groupBy(F.col("user_id").alias("first_user")).agg(F.min("ts").alias("t0"))
    ids = D.CHART_ITEMS + UNKNOWN_CHART
    item = F.element_at(F.array(*[F.lit(i) for i in ids]), (F.pmod("event_id", F.lit(len(ids))) + 1).cast("int"))
    texts = F.array(*[F.lit(t) for t, _ in D.CATEGORY_CODES])
    coded = [i for g in TEXT_GROUPS for i in D.ITEM_GROUPS[g]]
    k = A.props_k()
    value = (F.when(F.col("itemid").isin(coded), F.element_at(texts, (F.pmod("event_id", F.lit(len(D.CATEGORY_CODES))) + 1).cast("int")))
             .when(k < 5, F.lit(None).cast("string")).when(k < 10, F.lit("n/a")).otherwise(F.col("value").cast("string")))
    seconds = F.floor((F.unix_timestamp("ts") - F.unix_timestamp("t0")) / 24)
    chart = (events.join(users, F.col("user_id") == F.col("subject_id")).join(first, F.col("user_id") == F.col("first_user"))
             .withColumn("itemid", item)
             .select("subject_id", "hadm_id", "itemid", (start + hours(F.pmod("hadm_id", F.lit(20))) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("charttime"),
                     value.alias("value")))
    labs = D.LAB_ITEMS + UNKNOWN_LAB
    lab_item = F.element_at(F.array(*[F.lit(i) for i in labs]), (F.pmod(F.col("l_partkey") + F.col("l_linenumber"), F.lit(len(labs))) + 1).cast("int"))
    lab = (lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
           .select(F.col("o_custkey").alias("subject_id"), F.lit(None).cast("long").alias("hadm_id"), lab_item.alias("itemid"),
                   (start + hours(F.pmod("l_partkey", F.lit(60)))).alias("charttime"), F.col("l_quantity").cast("string").alias("value")))
    stays = lines.select(F.col("l_orderkey").alias("hadm_id"), F.col("l_linenumber").cast("long").alias("icustay_id"),
                         (start + hours(F.pmod("l_orderkey", F.lit(20)))).alias("intime"))
    return {"patients": A.patients_from_customer(table(spark, d, "customer")), "admissions": A.admissions_from_orders(orders),
            "icustays": stays, "chart": chart, "lab": lab}


def prepared(spark, d, hours: int, feature_set: str) -> pipeline.Prepared:
    return pipeline.prepare_events(**raw_tables(spark, d), hours=hours, feature_set=feature_set)


# --- the same in SQL; all lists and numbers below are FIXED VALUES, written out by hand ---

SQL_CHART_IDS = """['8377','115','3348','8368','220051','225310','8555','8441','220180','8502','8440','8503','8504','8507','8506','224643','3420','223835','3422','189','727','184','220739','454','223901','198','723','223900','807','811','1529','3745','225664','220621','226537','211','220045','226707','226730','1394','52','220052','225312','224','6702','224322','456','220181','3312','3314','3316','3320','3322','834','8498','220227','646','220277','618','220210','3603','224689','614','651','224422','615','224690','51','220050','225309','6701','455','220179','3313','3315','442','3317','3321','3323','224167','227243','3655','677','676','223762','3654','678','223761','679','763','224639','226512','3580','3693','3581','226531','3582','3839','1673','780','1126','223830','4753','4202','860','220274']"""
SQL_LAB_IDS = "['50931','50809','51478','50817','50820','51491','50831','51094','51300','51301','50971','50822','51006']"
SQL_TEXTS = """['Normal <3 secs','Abnormal >3 secs','Other/Remarks','Abnormal Flexion','Inappropriate Words','Confused','To Pain','Spontaneously','Oriented','Incomprehensible ...','Flex-withdraws','Abnormal extension','Localizes Pain','Obeys Commands','To Speech','No response','No Response','No Response-ETT']"""
SQL_CODES = "['0','1','2','3','3','4','2','4','5','2','4','2','5','6','3','1','1','1']"
SQL_GROUP = """CASE
  WHEN itemid IN ('8377','115','3348') THEN 'CRR'
  WHEN itemid IN ('8368','220051','225310','8555','8441','220180','8502','8440','8503','8504','8507','8506','224643') THEN 'DBP'
  WHEN itemid IN ('3420','223835','3422','189','727') THEN 'FIO'
  WHEN itemid IN ('184','220739') THEN 'GO' WHEN itemid IN ('454','223901') THEN 'GMR' WHEN itemid = '198' THEN 'GT'
  WHEN itemid IN ('723','223900') THEN 'GVR'
  WHEN itemid IN ('50931','807','811','1529','50809','51478','3745','225664','220621','226537') THEN 'GLU'
  WHEN itemid IN ('211','220045') THEN 'HR' WHEN itemid IN ('226707','226730','1394') THEN 'HEIGHT'
  WHEN itemid IN ('52','220052','225312','224','6702','224322','456','220181','3312','3314','3316','3320','3322') THEN 'MBP'
  WHEN itemid IN ('834','50817','8498','220227','646','220277') THEN 'OS'
  WHEN itemid IN ('618','220210','3603','224689','614','651','224422','615','224690') THEN 'RESPR'
  WHEN itemid IN ('51','220050','225309','6701','455','220179','3313','3315','442','3317','3321','3323','224167','227243') THEN 'SBP'
  WHEN itemid IN ('3655','677','676','223762','3654','678','223761','679') THEN 'TEMP'
  WHEN itemid IN ('763','224639','226512','3580','3693','3581','226531','3582') THEN 'WEIGHT'
  WHEN itemid IN ('50820','51491','3839','1673','50831','51094','780','1126','223830','4753','4202','860','220274') THEN 'PH'
  WHEN itemid IN ('51300','51301') THEN 'WBC' WHEN itemid IN ('50971','50822') THEN 'POTA' WHEN itemid = '51006' THEN 'UREA'
  ELSE itemid END"""
SQL_UNITS = """CASE WHEN itemid IN ('226707','1394') THEN v * 2.54 WHEN itemid IN ('3654','678','223761','679') THEN (v - 32.0) * 5.0 / 9.0
  WHEN itemid IN ('3581','226531') THEN v * 0.45 WHEN itemid = '3582' THEN v * 0.02835 ELSE v END"""
SQL_OUTLIER_13 = """coalesce((g = 'GLU' AND value > 5000) OR (g = 'DBP' AND value > 1000) OR (g = 'HEIGHT' AND value > 300) OR (g = 'HR' AND value > 10000)
  OR (g = 'MBP' AND value > 1000) OR (g = 'OS' AND value > 10000) OR (g = 'PH' AND value > 10) OR (g = 'RESPR' AND value > 1000)
  OR (g = 'SBP' AND value > 1000) OR (g = 'TEMP' AND (value > 50 OR value < 20)) OR (g = 'WEIGHT' AND (value > 1000 OR value < 10)), false)"""
SQL_OUTLIER_15 = SQL_OUTLIER_13.replace("(g = 'DBP' AND value > 1000)", "(g = 'DBP' AND (value > 1000 OR value < 0))").replace(
    "(g = 'MBP' AND value > 1000)", "(g = 'MBP' AND (value > 1000 OR value < 0))")
SQL_IMPUTE = {"CRR": 0.0, "DBP": 59.0, "FIO": 52.0, "GLU": 128.0, "GMR": 6.0, "GO": 4.0, "GT": 15.0, "GVR": 5.0, "HEIGHT": 170.0, "HR": 86.0, "MBP": 77.0,
              "OS": 98.0, "PH": 7.4, "RESPR": 19.0, "SBP": 118.0, "TEMP": 36.6, "WEIGHT": 81.0, "POTA": 4.14, "UREA": 25.0, "WBC": 11.81}


def sql_events(hours: int, feature_set: str) -> str:
    chart = f"""
SELECT subject_id, hadm_id, itemid, charttime, {SQL_UNITS} AS value FROM (
  SELECT c.subject_id, c.hadm_id, c.itemid, c.charttime,
         TRY_CAST(coalesce({SQL_CODES}[list_position({SQL_TEXTS}, c.value)], nullif(split_part(c.value, ' ', 1), '')) AS DOUBLE) AS v
  FROM chart c JOIN stays s ON c.hadm_id = s.hadm_id
  WHERE list_contains({SQL_CHART_IDS}, c.itemid) AND c.value IS NOT NULL AND epoch(c.charttime) - epoch(s.intime) < {hours} * 3600)"""
    labs = f"""
SELECT s.subject_id, s.hadm_id, l.itemid, l.charttime, TRY_CAST(l.value AS DOUBLE) AS value FROM lab l JOIN stays s ON l.subject_id = s.subject_id
WHERE list_contains({SQL_LAB_IDS}, l.itemid) AND epoch(l.charttime) - epoch(s.intime) > 0 AND epoch(l.charttime) - epoch(s.intime) < {hours} * 3600"""
    return f"""WITH {Q.SQL_PATIENTS}, {Q.SQL_ADMISSIONS}, {Q.SQL_ADULTS}, {Q.SQL_COHORT},
stays AS (SELECT subject_id, hadm_id, TIMESTAMP '2000-01-01' + to_hours(hadm_id % 20) AS intime FROM cohort),
users AS (SELECT o_custkey AS subject_id, min(o_orderkey) AS hadm_id FROM orders WHERE o_orderkey IN (SELECT hadm_id FROM singles) GROUP BY 1),
begins AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY 1),
raw AS (SELECT u.subject_id, u.hadm_id, list_concat({SQL_CHART_IDS}, ['999001','999002','999003'])[e.event_id % 109 + 1] AS itemid,
               TIMESTAMP '2000-01-01' + to_hours(u.hadm_id % 20) + to_seconds(floor((floor(epoch(e.ts)) - floor(epoch(b.t0))) / 24)) AS charttime, e.value, e.event_id,
               TRY_CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INTEGER) AS k
        FROM events e JOIN users u ON e.user_id = u.subject_id JOIN begins b ON b.user_id = e.user_id),
chart AS (SELECT subject_id, hadm_id, itemid, charttime,
                 CASE WHEN itemid IN ('8377','115','3348','184','220739','454','223901','198','723','223900') THEN {SQL_TEXTS}[event_id % 18 + 1]
                      WHEN k < 5 THEN NULL WHEN k < 10 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value FROM raw),
lab AS (SELECT o_custkey AS subject_id, list_concat({SQL_LAB_IDS}, ['998001','998002'])[(l_partkey + l_linenumber) % 15 + 1] AS itemid,
               TIMESTAMP '2000-01-01' + to_hours(l_partkey % 60) AS charttime, CAST(l_quantity AS VARCHAR) AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
typed AS ({chart}{' UNION ALL ' + labs if feature_set == 'B' else ''}),
grouped AS (SELECT subject_id, hadm_id, {SQL_GROUP} AS g, charttime, value FROM typed)"""


def _features(feature_set: str) -> list[str]:
    return sorted(f for f in SQL_IMPUTE if feature_set == "B" or f not in ("POTA", "UREA", "WBC"))


def sql_features(hours: int, feature_set: str) -> str:
    cols = ", ".join(Q.r6(f"coalesce(avg(value) FILTER (WHERE g = '{f}'), {SQL_IMPUTE[f]!r})") + f" AS {f}" for f in _features(feature_set))
    who = ", " + Q.r6("c.age") + " AS age, CASE WHEN c.gender = 'F' THEN 0 ELSE 1 END AS gender_01" if feature_set == "B" else ""
    return (f"{sql_events(hours, feature_set)}, wide AS (SELECT hadm_id, {cols} FROM grouped WHERE NOT {SQL_OUTLIER_13} GROUP BY hadm_id)\n"
            f"SELECT w.*{who}, c.hospital_expire_flag FROM wide w LEFT JOIN cohort c ON w.hadm_id = c.hadm_id")


def sql_sequences(hours: int, feature_set: str) -> str:
    feats = _features(feature_set)
    cols = feats + (["age", "gender_num"] if feature_set == "B" else [])
    means = ", ".join(f"avg(value) FILTER (WHERE g = '{f}') AS {f}" for f in feats)
    who = (", demo AS (SELECT h.*, c.age, CASE WHEN c.gender = 'M' THEN 0 ELSE 1 END AS gender_num FROM hourly h JOIN cohort c ON h.hadm_id = c.hadm_id)"
           if feature_set == "B" else ", demo AS (SELECT * FROM hourly)")
    limit = {24: 30, 48: 60}[hours]
    total = " + ".join(cols)
    return (f"{sql_events(hours, feature_set)}, hourly AS (SELECT hadm_id, strftime(charttime, '%Y-%m-%d %H') AS time, {means} FROM grouped\n"
            f"WHERE NOT {SQL_OUTLIER_15} GROUP BY 1, 2){who}, {Q.sql_minmax('demo', cols)},\n"
            f"kept AS (SELECT hadm_id, CAST(count(*) AS INTEGER) AS num_stamps, sum({total}) AS vs FROM scaled GROUP BY hadm_id HAVING count(*) <= {limit})\n"
            f"SELECT k.hadm_id, k.num_stamps, {Q.r6('k.vs')} AS value_sum, c.hospital_expire_flag FROM kept k JOIN cohort c ON k.hadm_id = c.hadm_id")


def _register(hours: int, feature_set: str) -> None:
    @Q.register(f"pipeline_features_{hours}h_{feature_set}", sql_features(hours, feature_set))
    def features(spark, d):
        p = prepared(spark, d, hours, feature_set)
        return Q.round_doubles(pipeline.mean_feature_table(p.events, p.patients_info, feature_set))

    @Q.register(f"pipeline_sequences_{hours}h_{feature_set}_real", sql_sequences(hours, feature_set))
    def sequences(spark, d):
        p = prepared(spark, d, hours, feature_set)
        seqs = pipeline.sequence_table(p.events, p.patients_info, hours, feature_set)
        total = F.aggregate(F.flatten("value"), F.lit(0.0), lambda acc, x: acc + x)
        return Q.round_doubles(seqs.select("hadm_id", "num_stamps", total.alias("value_sum"), "hospital_expire_flag"))


for _h in (24, 48):
    for _s in ("A", "B"):
        _register(_h, _s)


@Q.register("pipeline_events_48h_B", sql_events(48, "B") + f"\nSELECT subject_id, hadm_id, g AS itemid, charttime, {Q.r6('value')} AS value FROM grouped")
def q_pipeline_events(spark, d):
    """Typed, converted and grouped events of chart and labs, row by row."""
    return Q.round_doubles(prepared(spark, d, 48, "B").events.select("subject_id", "hadm_id", "itemid", "charttime", "value"))


def _cell_sql(hours: int, feature_set: str) -> str:
    own = ", age, gender_01" if feature_set == "B" else ", NULL::DOUBLE AS age, NULL::INTEGER AS gender_01"
    feats = ", ".join(f if f in _features(feature_set) else f"NULL::DOUBLE AS {f}" for f in _features("B"))
    return f"SELECT {hours} AS hours, '{feature_set}' AS feature_set, hadm_id, {feats}{own}, hospital_expire_flag FROM ({sql_features(hours, feature_set)})"


@Q.register("pipeline_features_all_cells", " UNION ALL ".join(_cell_sql(h, s) for h in (24, 48) for s in ("A", "B")))
def q_pipeline_features_all_cells(spark, d):
    """The feature tables of both windows and both sets from one scan of each event table."""
    return Q.round_doubles(pipeline.feature_cells(**raw_tables(spark, d)))


@Q.register("pipeline_sequences_all_cells", " UNION ALL ".join(
    f"SELECT {h} AS hours, '{s}' AS feature_set, * FROM ({sql_sequences(h, s)})" for h in (24, 48) for s in ("A", "B")))
def q_pipeline_sequences_all_cells(spark, d):
    """The sequence tables of both windows and both sets from one scan of each event table."""
    seqs = pipeline.sequence_cells(**raw_tables(spark, d))
    total = F.aggregate(F.flatten("value"), F.lit(0.0), lambda acc, x: acc + x)
    return Q.round_doubles(seqs.select("hours", "feature_set", "hadm_id", "num_stamps", total.alias("value_sum"), "hospital_expire_flag"))


@Q.register("preparation_outputs", sql_events(48, "B") + f"""
SELECT 'chartLab48Item20' AS output, subject_id, hadm_id, g AS itemid, charttime, {Q.r6('value')} AS value FROM grouped
UNION ALL SELECT 'chart24Item17', subject_id, hadm_id, g, charttime, {Q.r6('value')} FROM ({sql_events(24, 'A')} SELECT * FROM grouped)
UNION ALL SELECT 'patientsInfo', subject_id, hadm_id, gender, NULL, {Q.r6('age')} FROM cohort""")
def q_preparation_outputs(spark, d):
    """The raw tables as CSV, the whole preparation job over them, and three of its 14 outputs read back."""
    base = scratch_path(spark, "preparation-query")
    for name, df in raw_tables(spark, d).items():
        text = df.withColumn("valueuom", F.lit("unit")) if name in ("chart", "lab") else df
        text = text.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind.startswith("timestamp")})
        write_csv(text.toDF(*[c.upper() for c in text.columns]), f"{base}/data/{pipeline.RAW_TABLES[name]}.csv")
    paths = pipeline.run_preparation(spark, f"{base}/data", f"{base}/out", resume_dir=f"{base}/stages")
    remove_path(spark, f"{base}/data")
    events = "SUBJECT_ID long, HADM_ID long, ITEMID string, CHARTTIME timestamp, VALUE double"
    read = lambda name, schema: load_csv_table(spark, paths[name], schema=schema).withColumn("output", F.lit(name))
    info = read("patientsInfo", "SUBJECT_ID long, HADM_ID long, AGE double, GENDER string, HOSPITAL_EXPIRE_FLAG int").select(
        "output", F.col("SUBJECT_ID").alias("subject_id"), F.col("HADM_ID").alias("hadm_id"), F.col("GENDER").alias("itemid"), F.lit(None).cast("timestamp_ntz").alias("charttime"), F.col("AGE").alias("value"))
    out = [read(n, events).select("output", *[F.col(c).alias(c.lower()) for c in ("SUBJECT_ID", "HADM_ID", "ITEMID", "CHARTTIME", "VALUE")])
           for n in ("chartLab48Item20", "chart24Item17")]
    out = [e.withColumn("charttime", F.col("charttime").cast("timestamp_ntz")) for e in out]
    return Q.round_doubles(out[0].unionByName(out[1]).unionByName(info))
