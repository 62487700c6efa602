"""End-to-end preparation and feature pipelines.

``prepare_events`` is the preparation job: cohort -> stay start -> chart and
lab windows -> typing -> union -> feature groups.  ``mean_feature_table`` and
``sequence_table`` are the two modelling inputs, parameterised by window
length (24 / 48 h) and feature set (A / B) instead of eight copied scripts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dictionary as D
from ..functions.columns import hour_key, minmax_scale
from ..operators import clean, cohort, features, sequences, windows
from ..session import persist, scratch_path


@dataclass
class Prepared:
    patients_info: DataFrame     # subject, hadm, age, gender, label
    chart: DataFrame             # typed chart events in the window
    lab: DataFrame               # typed lab events in the window
    events: DataFrame            # chart (+ lab for set B), item = feature group


def prepare_events(patients: DataFrame, admissions: DataFrame, icustays: DataFrame, chart: DataFrame,
                   lab: DataFrame, hours: int = 24, feature_set: str = "B",
                   chart_items=D.CHART_ITEMS, lab_items=D.LAB_ITEMS, groups=D.ITEM_GROUPS,
                   unit_rules=D.UNIT_RULES, codes=D.CATEGORY_CODES, min_age: float = 18.0) -> Prepared:
    """The preparation job over the five raw tables (lower-case clinical names).

    * cohort: adults with exactly one ICU stay (semi-joins, no driver lists);
    * chart: item filter before the join, ``hours < H`` from ICU start;
    * lab: equi-join on subject with ``0 < hours < H`` (interval join);
    * typing: null drop, category codes, double parse, unit conversion;
    * set A uses chart only, set B adds labs; items become feature groups.
    """
    started = cohort.cohort_with_start(patients, admissions, icustays, min_age)
    info, stays = started.drop("intime"), started.select("subject_id", "hadm_id", "intime")
    cols = list(clean.EVENT_COLUMNS)

    chart_w = windows.chart_window(chart, stays, hours, chart_items)
    chart_t = clean.type_chart_events(chart_w.select(*cols), cols, codes, unit_rules)

    lab_sel = windows.select_items(lab, lab_items)
    lab_w = windows.interval_join(lab_sel, stays, hours, key="subject_id", stay_cols=("hadm_id",))
    lab_t = clean.type_lab_events(lab_w.select(*cols), cols)

    ev = chart_t if feature_set.upper() == "A" else clean.union_events(chart_t, lab_t)
    return Prepared(info, chart_t, lab_t, clean.assign_groups(ev, "itemid", groups))


def mean_feature_table(events: DataFrame, patients_info: DataFrame, feature_set: str = "A",
                       rules=D.OUTLIER_RULES_13) -> DataFrame:
    """Outliers (13 rules) -> mean per feature -> imputation -> label (+ age, sex)."""
    cleaned = clean.drop_outliers(events, rules, "itemid", "value")
    return features.feature_table(cleaned, patients_info, feature_set)


CELLS = ((24, "A"), (24, "B"), (48, "A"), (48, "B"))


def cell_events(patients: DataFrame, admissions: DataFrame, icustays: DataFrame, chart: DataFrame, lab: DataFrame,
                cells: Sequence[tuple[int, str]] = CELLS, min_age: float = 18.0) -> tuple[DataFrame, DataFrame]:
    """(patients info, events) of several (hours, feature set) cells from one scan of each event table.

    The events are those of the longest window, typed and grouped once; the array ``cells``
    of a row lists the places of the cells it belongs to.
    """
    started = cohort.cohort_with_start(patients, admissions, icustays, min_age)
    info, stays = started.drop("intime"), started.select("subject_id", "hadm_id", "intime")
    cols, longest = list(clean.EVENT_COLUMNS), max(h for h, _ in cells)
    chart_w = windows.chart_window(chart, stays, longest, D.CHART_ITEMS).select(*cols, "hours")
    lab_w = windows.interval_join(windows.select_items(lab, D.LAB_ITEMS), stays, longest, key="subject_id", stay_cols=("hadm_id",)).select(*cols, "hours")
    both = (clean.type_chart_events(chart_w, cols, keep=["hours"]).withColumn("from_lab", F.lit(False))
            .unionByName(clean.type_lab_events(lab_w, cols, keep=["hours"]).withColumn("from_lab", F.lit(True))))
    # The lower bounds agree per source, so a shorter window is a filter on the longest.
    mine = [F.when((F.col("hours") < F.lit(float(h))) & (F.lit(s.upper() == "B") | ~F.col("from_lab")), k) for k, (h, s) in enumerate(cells)]
    return info, clean.assign_groups(both.withColumn("cells", F.array_compact(F.array(*mine))))


def _cell_names(cells: Sequence[tuple[int, str]]) -> Column:
    return F.array(*[F.struct(F.lit(h).alias("hours"), F.lit(s.upper()).alias("feature_set")) for h, s in cells])


def feature_cells(patients: DataFrame, admissions: DataFrame, icustays: DataFrame, chart: DataFrame, lab: DataFrame,
                  cells: Sequence[tuple[int, str]] = CELLS, rules=D.OUTLIER_RULES_13, min_age: float = 18.0) -> DataFrame:
    """The mean-feature tables of all cells as one plan: hours, feature_set, then the columns of set B.

    An event is listed once for each cell it belongs to, so one aggregation of ordinary width gives the
    means of every cell.  In set A the features and demographics of set B alone are null.
    """
    info, events = cell_events(patients, admissions, icustays, chart, lab, cells, min_age)
    events = clean.drop_outliers(events, rules, "itemid", "value")
    feats = D.FEATURES_SET_B
    each = events.select("hadm_id", "itemid", "value", F.explode("cells").alias("cell"))
    wide = each.groupBy("hadm_id", "cell").agg(*[F.avg(F.when(F.col("itemid") == f, F.col("value"))).alias(f) for f in feats])
    c = F.element_at(_cell_names(cells), F.col("cell") + 1)
    filled = []
    for f in feats:
        value = F.lit(None).cast("double")
        for s in dict.fromkeys(s.upper() for _, s in cells):
            constants = D.imputation_for(s)
            if f in constants:
                value = F.when(F.col("c.feature_set") == s, F.coalesce(F.col(f), F.lit(float(constants[f])))).otherwise(value)
        filled.append(value.alias(f))
    rows = wide.withColumn("c", c).select("hadm_id", "c.*", *filled)
    static = features.static_info(info)
    joined = rows.join(static, "hadm_id", "left")
    in_b = F.col("feature_set") == "B"
    return joined.withColumns({"age": F.when(in_b, F.col("age")), "gender_01": F.when(in_b, F.col("gender_01"))})


def sequence_cells(patients: DataFrame, admissions: DataFrame, icustays: DataFrame, chart: DataFrame, lab: DataFrame,
                   cells: Sequence[tuple[int, str]] = CELLS, rules=D.OUTLIER_RULES_15, min_age: float = 18.0) -> DataFrame:
    """The sequence tables of all cells as one plan: hours, feature_set, hadm_id, value, num_stamps, label.

    An event is listed once for each cell it belongs to, so one aggregation of ordinary width gives the
    hourly means of every cell.  Scaling uses each cell's own minima and maxima, one row of numbers a
    cell.  The persisted hourly rows are read by that fit and by the sequences.
    """
    info, events = cell_events(patients, admissions, icustays, chart, lab, cells, min_age)
    events = clean.drop_outliers(events, rules, "itemid", "value")
    feats = D.FEATURES_SET_B
    each = events.select("hadm_id", F.date_trunc("hour", "charttime").alias("hour"), "itemid", "value", F.explode("cells").alias("cell"))
    means = each.groupBy("hadm_id", "hour", "cell").agg(*[F.avg(F.when(F.col("itemid") == f, F.col("value"))).alias(f) for f in feats])
    rows = means.select("hadm_id", hour_key("hour").alias("time"), "cell", *feats)
    hourly = persist(sequences.add_demographics(rows, info))
    columns = [sequences.sequence_feature_columns(s) for _, s in cells]
    every = max(columns, key=len)
    fits = {r["cell"]: r for r in hourly.groupBy("cell").agg(*[g(c).alias(f"{n}_{c}") for c in every for n, g in (("lo", F.min), ("hi", F.max))]).collect()}

    def bound(name: str) -> Column:
        # The cells' bounds of a column as one literal array: the expressions do not grow with the cells.
        return F.element_at(F.array(*[F.lit(None if k not in fits else fits[k][name]).cast("double") for k in range(len(cells))]), F.col("cell") + 1)

    scaled = hourly.select("cell", "hadm_id", "time", *[F.coalesce(minmax_scale(c, bound(f"lo_{c}"), bound(f"hi_{c}")), F.lit(-1.0)).alias(c) for c in every])
    row = None
    for cols in {tuple(c): c for c in columns}.values():
        own = F.array(*[F.col(c) for c in cols])
        inside = F.col("cell").isin([k for k, c in enumerate(columns) if c == cols])
        row = F.when(inside, own) if row is None else row.when(inside, own)
    rows = scaled.select("cell", "hadm_id", "time", row.alias("row"))
    limit = F.element_at(F.array(*[F.lit(D.MAX_STEPS[h]) for h, _ in cells]), F.col("cell") + 1)
    keep = rows.groupBy("cell", "hadm_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= limit).select("cell", "hadm_id")
    seqs = (rows.join(keep, ["cell", "hadm_id"], "left_semi").groupBy("cell", "hadm_id")
            .agg(F.sort_array(F.collect_list(F.struct("time", "row"))).alias("s"))
            .select("cell", "hadm_id", F.transform("s", lambda x: x["row"]).alias("value"), F.size("s").alias("num_stamps")))
    named = seqs.withColumn("c", F.element_at(_cell_names(cells), F.col("cell") + 1)).select("c.*", "hadm_id", "value", "num_stamps")
    return sequences.sequences_with_label(named, info)


def hourly_table(events: DataFrame, patients_info: DataFrame, feature_set: str = "A",
                 rules=D.OUTLIER_RULES_15) -> DataFrame:
    """Outliers (15 rules) -> hourly (admission, hour) x feature means (+ demographics in B)."""
    cleaned = clean.drop_outliers(events, rules, "itemid", "value")
    hourly = sequences.hourly_features(cleaned, D.features_for(feature_set))
    if feature_set.upper() == "B":
        hourly = sequences.add_demographics(hourly, patients_info)
    return hourly


def sequence_table(events: DataFrame, patients_info: DataFrame, hours: int = 24, feature_set: str = "A",
                   rules=D.OUTLIER_RULES_15, max_steps: int | None = None) -> DataFrame:
    """Hourly means -> min-max scaling -> -1 fill -> ordered sequences <= T steps -> label."""
    # Read twice (scaler fit, then scaling): keep it rather than recompute the chain.
    hourly = persist(hourly_table(events, patients_info, feature_set, rules))
    cols = sequences.sequence_feature_columns(feature_set)
    scaled = sequences.minmax_apply(hourly, sequences.minmax_fit(hourly, cols))
    if max_steps is None and hours not in D.MAX_STEPS:
        raise ValueError(f"no length limit is known for a window of {hours} h: give max_steps")
    limit = max_steps if max_steps is not None else D.MAX_STEPS[hours]
    seqs = sequences.build_sequences(scaled, cols, limit)
    return sequences.sequences_with_label(seqs, patients_info)


def load_raw_tables(spark, data_dir: str) -> dict[str, DataFrame]:
    """Read the five raw CSV tables (all-string, malformed rows dropped) and type their keys."""
    from ..sources.csv import load_csv_table
    raw = {k: load_csv_table(spark, f"{data_dir.rstrip('/')}/{v}.csv") for k, v in RAW_TABLES.items()}

    def lower(df):
        return df.toDF(*[c.lower() for c in df.columns])
    t = {k: lower(v) for k, v in raw.items()}
    long_cols = ("subject_id", "hadm_id", "icustay_id")
    for k, df in t.items():
        casts = {c: F.col(c).try_cast("long") for c in long_cols if c in df.columns}
        for c in ("dob", "admittime", "intime"):
            if c in df.columns:
                casts[c] = F.try_to_timestamp(F.col(c))
        if "hospital_expire_flag" in df.columns:
            casts["hospital_expire_flag"] = F.col("hospital_expire_flag").try_cast("int")
        t[k] = df.withColumns(casts) if casts else df
    return t


# The names of the 14 outputs.
OUTPUTS = ("chartWithTimeSelected", "chart24Hr", "chart48Hr", "lab24Hr", "lab48Hr", "chart24", "chart48",
           "chartLab24", "chartLab48", "patientsInfo", "chart24Item17", "chart48Item17", "chartLab24Item20",
           "chartLab48Item20")


RAW_TABLES = {"patients": "PATIENTS", "admissions": "ADMISSIONS", "chart": "CHARTEVENTS", "lab": "LABEVENTS", "icustays": "ICUSTAYS"}


def run_preparation(spark, data_dir: str, out_dir: str, fmt: str = "csv", single_file: bool = False,
                    min_age: float = 18.0, resume_dir: str | None = None) -> dict[str, str]:
    """The whole preparation job: five raw CSV tables -> the 14 outputs.

    The cohort, the selected chart events and the 48 h windows are each computed once
    and written as stages; every output and every 24 h set is read from a stage, so no
    join runs twice.  With ``resume_dir``, a folder that outlives the driver, a job that
    died goes on from its first missing stage or output (``sources.stages``), unless an
    input file has changed; without it the stages go to the scratch folder.  They are
    deleted at the end.  Returns output name -> path.
    """
    from ..sources.csv import write_csv
    from ..sources.stages import Stages
    t = load_raw_tables(spark, data_dir)
    job = Stages(spark, resume_dir or scratch_path(spark, "preparation"), f"1 {min_age} {fmt} {single_file}")
    for name, file in RAW_TABLES.items():
        job.source(name, f"{data_dir.rstrip('/')}/{file}.csv")
    started = job.stage("cohort", ["patients", "admissions", "icustays"],
                        lambda: cohort.cohort_with_start(t["patients"], t["admissions"], t["icustays"], min_age))
    info, stays = started.drop("intime"), started.select("subject_id", "hadm_id", "intime")
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}

    def emit(name: str, df: DataFrame, made_from: list[str]) -> None:
        target = f"{out}/{name}.{fmt}"

        def write() -> None:
            upper = df.toDF(*[c.upper() for c in df.columns])   # the consumers of the files read upper-case headers
            if fmt == "csv":
                write_csv(upper, target, single_file)
            else:
                upper.write.mode("overwrite").parquet(target)

        paths[name] = job.effect(f"output_{name}", made_from, target, write)

    raw_cols = ["subject_id", "hadm_id", "itemid", "charttime", "value", "valueuom"]
    selected = job.stage("selected", ["cohort", "chart"],
                         lambda: windows.attach_stay_start(windows.select_items(t["chart"], D.CHART_ITEMS), stays))
    emit("chartWithTimeSelected", selected.select(*raw_cols, "intime"), ["selected"])
    chart48 = job.stage("window_chart", ["selected"], lambda: windows.open_window(windows.with_hours(selected), 48).select(*raw_cols, "hours"))
    lab48 = job.stage("window_lab", ["cohort", "lab"], lambda: windows.interval_join(
        windows.select_items(t["lab"], D.LAB_ITEMS), stays, 48, key="subject_id", stay_cols=("hadm_id",)).select(*raw_cols, "hours"))
    cols = list(clean.EVENT_COLUMNS)
    typed = {}
    for h in (48, 24):
        chart_h, lab_h = windows.open_window(chart48, h), windows.open_window(lab48, h)
        emit(f"chart{h}Hr", chart_h.select(*raw_cols), ["window_chart"])
        emit(f"lab{h}Hr", lab_h.select(*raw_cols), ["window_lab"])
        c = job.stage(f"typed_chart{h}", ["window_chart"], lambda df=chart_h: clean.type_chart_events(df.select(*cols), cols))
        lab = job.stage(f"typed_lab{h}", ["window_lab"], lambda df=lab_h: clean.type_lab_events(df.select(*cols), cols))
        typed[f"chart{h}", 17] = c, [f"typed_chart{h}"]
        typed[f"chartLab{h}", 20] = clean.union_events(c, lab), [f"typed_chart{h}", f"typed_lab{h}"]
    emit("patientsInfo", info, ["cohort"])
    for (name, items), (df, made_from) in typed.items():
        emit(name, df, made_from)
        emit(f"{name}Item{items}", clean.assign_groups(df), made_from)
    job.clear()
    return paths
