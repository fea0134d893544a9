"""Row-level functions (H1-H19), all JVM built-ins.

Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall time, so results never
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_to_ts(col) -> Column:
    """H1: epoch seconds (number or numeric text) -> UTC timestamp."""
    secs = _c(col).try_cast("double").try_cast("bigint")
    return F.timestamp_add("SECOND", secs, F.expr(EPOCH_NTZ))


def ts_to_epoch(col) -> Column:
    """H2: UTC timestamp -> epoch seconds."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), _c(col))


def to_ts(col) -> Column:
    """H3: tolerant text -> timestamp (bad text -> null)."""
    return F.try_to_timestamp(_c(col).cast("string")).cast("timestamp_ntz")


def to_double(col) -> Column:
    """H4: tolerant value -> double (bad text -> null, NaN -> null)."""
    d = _c(col).try_cast("double")
    return F.when(~F.isnan(d), d)


def day_floor(col) -> Column:
    """Start of the UTC day, kept as TIMESTAMP_NTZ."""
    return _c(col).cast("date").cast("timestamp_ntz")


def hour_floor(col) -> Column:
    """Start of the UTC hour, kept as TIMESTAMP_NTZ."""
    epoch = F.expr(EPOCH_NTZ)
    return F.timestamp_add("HOUR", F.timestamp_diff("HOUR", epoch, _c(col)), epoch)


def weekday_monday0(col) -> Column:
    """H5: day of week with Monday = 0."""
    return F.weekday(_c(col))


def safe_div(a, b) -> Column:
    """Division that yields null for a zero or null divisor (no +-inf)."""
    return F.try_divide(_c(a), _c(b))


def log_return(close, prev_close) -> Column:
    """ln(close / previous close); null where undefined."""
    return F.ln(safe_div(close, prev_close))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 integer, missing -> 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def strip_prefix(col, prefix: str) -> Column:
    """Remove every occurrence of ``prefix`` text."""
    return F.replace(_c(col), F.lit(prefix), F.lit(""))


def scale(col, center, scale_) -> Column:
    """(x - center) / scale."""
    return (_c(col) - _c(center)) / _c(scale_)
