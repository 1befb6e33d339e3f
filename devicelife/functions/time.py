"""Date and time expressions.

Timestamps stay ``timestamp_ntz`` (wall-clock readings without a zone).
Arithmetic goes through epoch microseconds, computed with the session time
zone pinned to UTC so that the NTZ -> instant cast is the identity.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date layouts accepted in report files, tried in this
# order (month/day/year first, then year/month/day).
DATE_FORMATS = ("M/d/yyyy", "yyyy/M/d")
TIME_FORMAT = "HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c) -> Column:
    return F.unix_micros(_c(c).cast("timestamp"))


def time_bucket(c, seconds: int = 300) -> Column:
    """Floor a timestamp to ``seconds``-wide buckets aligned to the epoch.

    Integer arithmetic on microseconds keeps it exact and null-safe (unlike
    ``window()``, which drops rows with a null time).
    """
    us = epoch_micros(c)
    step = F.lit(int(seconds) * 1_000_000)
    return F.timestamp_micros(us - F.pmod(us, step)).cast("timestamp_ntz")


def parse_date_any(c, formats=DATE_FORMATS) -> Column:
    """First format that parses wins; text no format accepts becomes null."""
    return F.coalesce(*[F.try_to_date(_c(c), f) for f in formats])


def combine_date_time(date_col, time_col, time_format: str = TIME_FORMAT) -> Column:
    """Date + time-of-day text to ``timestamp_ntz`` (strict on the time text)."""
    text = F.concat(_c(date_col).cast("string"), F.lit(" "), _c(time_col))
    return F.to_timestamp_ntz(text, F.lit(f"yyyy-MM-dd {time_format}"))


def minutes_between(later, earlier) -> Column:
    """Whole minutes from ``earlier`` to ``later``, truncated toward zero."""
    d = epoch_micros(later) - epoch_micros(earlier)
    return F.when(d >= 0, F.floor(d / 60_000_000)).otherwise(F.ceil(d / 60_000_000)).cast("long")


def calendar_features(ts) -> dict[str, Column]:
    t = _c(ts)
    return {"Hour": F.hour(t).cast("int"), "Minute": F.minute(t).cast("int"), "Month": F.month(t).cast("int")}
