"""Column expressions (all built-in Spark functions, no UDFs)."""

from devicelife.functions.time import (calendar_features, combine_date_time, epoch_micros,
                                       minutes_between, parse_date_any, time_bucket)
from devicelife.functions.values import any_flag, blank_to_null, cast_strict, safe_ratio

__all__ = [
    "any_flag", "blank_to_null", "calendar_features", "cast_strict", "combine_date_time",
    "epoch_micros", "minutes_between", "parse_date_any", "safe_ratio", "time_bucket",
]
