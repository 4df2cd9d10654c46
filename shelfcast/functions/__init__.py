from shelfcast.functions.dates import as_of_date, parse_ymd
from shelfcast.functions.rules import (
    accuracy_flag,
    ape,
    clean_label,
    floor_qty,
    half_even,
    outlier_flag,
    out_of_range_flag,
    percent_of,
    round_pred,
    safe_ratio,
    temp_code,
    temp_range,
)

__all__ = [
    "accuracy_flag",
    "as_of_date",
    "ape",
    "clean_label",
    "floor_qty",
    "half_even",
    "out_of_range_flag",
    "outlier_flag",
    "parse_ymd",
    "percent_of",
    "round_pred",
    "safe_ratio",
    "temp_code",
    "temp_range",
]
