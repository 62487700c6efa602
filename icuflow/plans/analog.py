"""Adapters from the driver's test tables to the clinical schema.

The test tables are not clinical, so each query maps them onto the roles of
the clinical tables and then runs the unchanged library operators:

* ``events``  -> chart events: user = admission = subject, event type = item,
  ``ts`` = chart time, ``value`` rendered as chart text (see below);
  stay start = first event of the user.
* ``customer`` -> patients and per-admission static info for the events.
* ``orders``   -> admissions (order = admission, customer = subject).
* ``lineitem`` -> ICU stays (one line = one stay of its order) and labs.

Chart text mirrors real chart values: most rows carry the number as text,
some carry non-numeric text and some are missing, chosen by the ``k``
number in ``props``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Item dictionary of the events analogue: event type -> feature group.
EVENT_ITEM_GROUPS = {
    "HR": ["click"],
    "MBP": ["view"],
    "GLU": ["purchase"],
    "TEMP": ["error"],
    "WEIGHT": ["signup"],
}
EVENT_ITEMS = ["click", "view", "purchase", "error", "signup"]
EVENT_SELECTED_ITEMS = ["click", "view", "error", "signup"]
# Unit rules of the events analogue (same rule kinds as the clinical ones).
EVENT_UNIT_RULES = [
    (["view", "error"], "f_to_c", None),
    (["signup"], "scale", 0.45),
]


def props_k(props: str = "props"):
    return F.regexp_extract(F.col(props), r"([0-9]+)", 1).cast("int")


def chart_from_events(events: DataFrame) -> DataFrame:
    """events -> chart events (subject_id, hadm_id, itemid, charttime, value text)."""
    k = props_k()
    text = (F.when(k < 5, F.lit(None).cast("string"))
            .when(k < 10, F.concat(F.lit("n/a "), F.col("event_type")))
            .otherwise(F.col("value").cast("string")))
    return events.select(F.col("user_id").alias("subject_id"), F.col("user_id").alias("hadm_id"),
                         F.col("event_type").alias("itemid"), F.col("ts").alias("charttime"),
                         text.alias("value"))


def stays_from_events(events: DataFrame) -> DataFrame:
    """Stay start per admission = first event of the user."""
    return (events.groupBy(F.col("user_id").alias("hadm_id"))
            .agg(F.min("ts").alias("intime"))
            .withColumn("subject_id", F.col("hadm_id")))


def late_stays_from_events(events: DataFrame, days: int = 14) -> DataFrame:
    """Stay start = ``days`` after the user's first event, so that the open window also holds earlier events
    and some admissions have more hourly steps than the window's limit."""
    return stays_from_events(events).withColumn("intime", F.col("intime") + F.make_dt_interval(F.lit(days)))


def patients_from_customer(customer: DataFrame) -> DataFrame:
    """customer -> patients (subject_id, gender, dob); birth date fixed by key."""
    key = F.col("c_custkey")
    dob = F.make_timestamp_ntz(F.lit(1930) + F.pmod(key, F.lit(60)).cast("int"),
                               F.lit(1) + F.pmod(key, F.lit(12)).cast("int"),
                               F.lit(1) + F.pmod(key, F.lit(28)).cast("int"),
                               F.lit(0), F.lit(0), F.lit(0))
    return customer.select(key.alias("subject_id"), F.substring("c_mktsegment", 1, 1).alias("gender"),
                           dob.alias("dob"))


def admissions_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> admissions (subject_id, hadm_id, admittime, hospital_expire_flag)."""
    return orders.select(F.col("o_custkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                         F.col("o_orderdate").alias("admittime"),
                         (F.col("o_orderstatus") == F.lit("F")).cast("int").alias("hospital_expire_flag"))


def icustays_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem -> ICU stays (hadm_id, icustay_id, intime)."""
    return lineitem.select(F.col("l_orderkey").alias("hadm_id"),
                           F.col("l_linenumber").cast("long").alias("icustay_id"),
                           F.col("l_shipdate").alias("intime"))


def labs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem -> labs keyed by order (no admission id of their own)."""
    return lineitem.select(F.col("l_orderkey").alias("subject_id"), F.lit(None).cast("long").alias("hadm_id"),
                           F.col("l_returnflag").alias("itemid"), F.col("l_shipdate").alias("charttime"),
                           F.col("l_quantity").cast("string").alias("value"))


def stays_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> stays for the interval join (subject_id = order key)."""
    return orders.select(F.col("o_orderkey").alias("subject_id"), F.col("o_orderkey").alias("hadm_id"),
                         F.col("o_orderdate").alias("intime"))


def info_from_customer(customer: DataFrame) -> DataFrame:
    """customer -> per-admission static info for event users (patientsInfo analogue)."""
    key = F.col("c_custkey")
    return customer.select(key.alias("subject_id"), key.alias("hadm_id"),
                           (F.lit(18.0) + F.pmod(key * F.lit(7), F.lit(70)).cast("double")).alias("age"),
                           F.substring("c_mktsegment", 1, 1).alias("gender"),
                           (F.col("c_acctbal") < F.lit(0.0)).cast("int").alias("hospital_expire_flag"))
