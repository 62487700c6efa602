"""Scalar column functions and the fixed clinical dictionary."""

from . import dictionary
from .columns import (age_years, categorical_code, epoch_seconds, feature_array, first_token,
                      hour_key, hours_between, item_group, minmax_scale, outlier_flag, pad_array,
                      parse_double, parse_timestamp, round6, sex_code, unit_convert)

__all__ = [
    "dictionary", "age_years", "categorical_code", "epoch_seconds", "feature_array", "first_token",
    "hour_key", "hours_between", "item_group", "minmax_scale", "outlier_flag", "pad_array",
    "parse_double", "parse_timestamp", "round6", "sex_code", "unit_convert",
]
