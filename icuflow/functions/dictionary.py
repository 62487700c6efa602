"""Clinical item dictionary and rule constants.

FIXED VALUES. Everything in this module must equal the values used by the
clinical preparation job and the modelling notebooks this library rebuilds;
they define the semantics (which measurements are kept, how they are named,
converted, cleaned and imputed).  They are stated as plain text, in the
order in which the original job lists them.
"""

from __future__ import annotations

# --- FIXED VALUES: selected chart item ids (106), in original order -------
CHART_ITEMS = [
    "8377", "115", "3348", "8368", "220051", "225310", "8555", "8441", "220180", "8502", "8440",
    "8503", "8504", "8507", "8506", "224643", "3420", "223835", "3422", "189", "727", "184", "220739", "454", "223901",
    "198", "723", "223900", "807", "811", "1529", "3745", "225664", "220621", "226537", "211", "220045", "226707",
    "226730", "1394", "52", "220052", "225312", "224", "6702", "224322", "456", "220181", "3312", "3314", "3316",
    "3320", "3322", "834", "8498", "220227", "646", "220277", "618", "220210", "3603", "224689", "614", "651", "224422",
    "615", "224690", "51", "220050", "225309", "6701", "455", "220179", "3313", "3315", "442", "3317", "3321", "3323",
    "224167", "227243", "3655", "677", "676", "223762", "3654", "678", "223761", "679", "763", "224639", "226512",
    "3580", "3693", "3581", "226531", "3582", "3839", "1673", "780", "1126", "223830", "4753", "4202", "860", "220274",
]

# --- FIXED VALUES: selected lab item ids (13), in original order ----------
LAB_ITEMS = ["50931", "50809", "51478", "50817", "50820", "51491", "50831", "51094", "51300", "51301", "50971",
             "50822", "51006"]

# --- FIXED VALUES: item id -> feature group, in original order ------------
# Ids not listed keep their own id as group name.
ITEM_GROUPS = {
    "CRR": ["8377", "115", "3348"],
    "DBP": ["8368", "220051", "225310", "8555", "8441", "220180", "8502", "8440",
            "8503", "8504", "8507", "8506", "224643"],
    "FIO": ["3420", "223835", "3422", "189", "727"],
    "GO": ["184", "220739"],
    "GMR": ["454", "223901"],
    "GT": ["198"],
    "GVR": ["723", "223900"],
    "GLU": ["50931", "807", "811", "1529", "50809", "51478", "3745", "225664", "220621", "226537"],
    "HR": ["211", "220045"],
    "HEIGHT": ["226707", "226730", "1394"],
    "MBP": ["52", "220052", "225312", "224", "6702", "224322", "456", "220181", "3312", "3314", "3316", "3320",
            "3322"],
    "OS": ["834", "50817", "8498", "220227", "646", "220277"],
    "RESPR": ["618", "220210", "3603", "224689", "614", "651", "224422", "615", "224690"],
    "SBP": ["51", "220050", "225309", "6701", "455", "220179", "3313", "3315", "442", "3317", "3321", "3323",
            "224167", "227243"],
    "TEMP": ["3655", "677", "676", "223762", "3654", "678", "223761", "679"],
    "WEIGHT": ["763", "224639", "226512", "3580", "3693", "3581", "226531", "3582"],
    "PH": ["50820", "51491", "3839", "1673", "50831", "51094", "780", "1126", "223830", "4753", "4202", "860",
           "220274"],
    "WBC": ["51300", "51301"],
    "POTA": ["50971", "50822"],
    "UREA": ["51006"],
}

# --- FIXED VALUES: categorical chart text -> numeric code, original order -
# Text not listed is replaced by its first space-separated token.
CATEGORY_CODES = [
    ("Normal <3 secs", "0"),
    ("Abnormal >3 secs", "1"),
    ("Other/Remarks", "2"),
    ("Abnormal Flexion", "3"),
    ("Inappropriate Words", "3"),
    ("Confused", "4"),
    ("To Pain", "2"),
    ("Spontaneously", "4"),
    ("Oriented", "5"),
    ("Incomprehensible ...", "2"),
    ("Flex-withdraws", "4"),
    ("Abnormal extension", "2"),
    ("Localizes Pain", "5"),
    ("Obeys Commands", "6"),
    ("To Speech", "3"),
    ("No response", "1"),
    ("No Response", "1"),
    ("No Response-ETT", "1"),
]

# --- FIXED VALUES: unit conversion by item id ------------------------------
# kind "scale": v * factor;  kind "f_to_c": (v - 32) * 5 / 9
UNIT_RULES = [
    (["226707", "1394"], "scale", 2.54),            # height inch -> cm
    (["3654", "678", "223761", "679"], "f_to_c", None),  # temperature F -> C
    (["3581", "226531"], "scale", 0.45),            # weight lb -> kg
    (["3582"], "scale", 0.02835),                   # weight oz -> kg
]

# --- FIXED VALUES: outlier rules (group, op, bound), drop when true -------
# 13 rules of the feature-table path, in original order.
OUTLIER_RULES_13 = [
    ("GLU", ">", 5000.0),
    ("DBP", ">", 1000.0),
    ("HEIGHT", ">", 300.0),
    ("HR", ">", 10000.0),
    ("MBP", ">", 1000.0),
    ("OS", ">", 10000.0),
    ("PH", ">", 10.0),
    ("RESPR", ">", 1000.0),
    ("SBP", ">", 1000.0),
    ("TEMP", ">", 50.0),
    ("TEMP", "<", 20.0),
    ("WEIGHT", ">", 1000.0),
    ("WEIGHT", "<", 10.0),
]
# 15 rules of the sequence path (adds DBP < 0 and MBP < 0), original order.
OUTLIER_RULES_15 = [
    ("GLU", ">", 5000.0),
    ("DBP", ">", 1000.0),
    ("DBP", "<", 0.0),
    ("HEIGHT", ">", 300.0),
    ("HR", ">", 10000.0),
    ("MBP", ">", 1000.0),
    ("MBP", "<", 0.0),
    ("OS", ">", 10000.0),
    ("PH", ">", 10.0),
    ("RESPR", ">", 1000.0),
    ("SBP", ">", 1000.0),
    ("TEMP", ">", 50.0),
    ("TEMP", "<", 20.0),
    ("WEIGHT", ">", 1000.0),
    ("WEIGHT", "<", 10.0),
]

# --- FIXED VALUES: imputation constants per feature ------------------------
IMPUTE_SET_A = {
    "CRR": 0.0, "DBP": 59.0, "FIO": 52.0, "GLU": 128.0, "GMR": 6.0, "GO": 4.0, "GT": 15.0, "GVR": 5.0,
    "HEIGHT": 170.0, "MBP": 77.0, "HR": 86.0, "OS": 98.0, "PH": 7.4, "RESPR": 19.0, "SBP": 118.0,
    "TEMP": 36.6, "WEIGHT": 81.0,
}
IMPUTE_SET_B_EXTRA = {"POTA": 4.14, "UREA": 25.0, "WBC": 11.81}
IMPUTE_SET_B = {**IMPUTE_SET_A, **IMPUTE_SET_B_EXTRA}

# Feature columns: pivoted groups sort alphabetically.
FEATURES_SET_A = sorted(IMPUTE_SET_A)
FEATURES_SET_B = sorted(IMPUTE_SET_B)

# Sex encodings of the two modelling paths: the listed value becomes 0,
# anything else 1.
SEX_ZERO_FEATURE_TABLE = "F"
SEX_ZERO_SEQUENCE = "M"

# Sequence length limit per window length (hours -> max hourly steps).
MAX_STEPS = {24: 30, 48: 60}


def features_for(feature_set: str) -> list[str]:
    """Feature group columns of set "A" (17) or "B" (20)."""
    return FEATURES_SET_A if feature_set.upper() == "A" else FEATURES_SET_B


def imputation_for(feature_set: str) -> dict[str, float]:
    return IMPUTE_SET_A if feature_set.upper() == "A" else IMPUTE_SET_B
