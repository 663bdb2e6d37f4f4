"""Date and time helpers (DT1-DT7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_years(birth, asof) -> Column:
    """Complete years between two dates (birthday not yet reached this year -> minus one)."""
    b, a = _c(birth), _c(asof)
    not_yet = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
    return (F.year(a) - F.year(b) - F.when(not_yet, 1).otherwise(0)).cast("long")


def hours_between(start, end) -> Column:
    """Complete hours from start to end (truncated toward zero)."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def days_between(start, end) -> Column:
    """Calendar days from start to end."""
    return F.datediff(_c(end), _c(start)).cast("long")


def parse_iso_ts(c) -> Column:
    """ISO-8601 text ('...T...Z' or '+hh:mm') -> TIMESTAMP_NTZ keeping the written wall clock.

    This is the source's ``cast(from_iso8601_timestamp(x) as timestamp(6))`` (S10), and it does
    not depend on the session time zone (an instant-then-local conversion would).
    """
    return _c(c).cast("timestamp_ntz")


_EPOCH = "1970-01-01 00:00:00"


def epoch_micros(ntz) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ wall clock (zone-independent)."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), _c(ntz))


def ntz_from_epoch_micros(us) -> Column:
    """Inverse of ``epoch_micros``."""
    return F.timestamp_add("MICROSECOND", _c(us), F.lit(_EPOCH).cast("timestamp_ntz"))


def event_time(ntz) -> Column:
    """TIMESTAMP instant for watermarks/windows: the NTZ wall clock read as UTC, in any session zone."""
    return F.timestamp_micros(epoch_micros(ntz))


def day_number(d) -> Column:
    """Days since epoch — an integer key for calendar range windows."""
    return F.unix_date(_c(d))
