"""Date and time functions (X5-X10, X18) as built-in column expressions.

Times in the inputs are text.  The action time may carry an unpadded hour
(``2024-01-05 0:03:04``), so it is parsed with a single ``H``, which reads one
or two digits.  Parsing is ``try_``-based: text that does not parse gives NULL
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four text formats of the reference.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
DATE_TIME_FORMAT = "yyyyMMddHHmm"

# Parse pattern accepting one- or two-digit hours.
TIME_PARSE_FORMAT = "yyyy-MM-dd H:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str) -> Column:
    """Action-time text -> TIMESTAMP (NULL if it does not parse)."""
    return F.try_to_timestamp(_col(c), F.lit(TIME_PARSE_FORMAT))


def parse_date_key(c: Column | str) -> Column:
    """``yyyyMMdd`` text -> DATE."""
    return F.to_date(F.try_to_timestamp(_col(c), F.lit(DATEKEY_FORMAT)))


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since the epoch of an action-time text."""
    return F.unix_timestamp(parse_time(c))


def time_before(a: Column | str, b: Column | str) -> Column:
    """``a`` strictly before ``b``."""
    return parse_time(a) < parse_time(b)


def time_after(a: Column | str, b: Column | str) -> Column:
    """``a`` strictly after ``b``."""
    return parse_time(a) > parse_time(b)


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """``a - b`` in whole seconds."""
    return epoch_seconds(a) - epoch_seconds(b)


def date_hour(c: Column | str) -> Column:
    """``yyyy-MM-dd_HH`` of an action time (hour padded to two digits)."""
    return F.date_format(parse_time(c), "yyyy-MM-dd_HH")


def format_date(ts: Column | str) -> Column:
    """Timestamp -> ``yyyy-MM-dd``."""
    return F.date_format(_col(ts), DATE_FORMAT)


def format_time(ts: Column | str) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_col(ts), TIME_FORMAT)


def format_date_key(ts: Column | str) -> Column:
    """Timestamp -> ``yyyyMMdd``."""
    return F.date_format(_col(ts), DATEKEY_FORMAT)


def format_time_minute(ts: Column | str) -> Column:
    """Timestamp -> ``yyyyMMddHHmm``."""
    return F.date_format(_col(ts), DATE_TIME_FORMAT)


def epoch_millis_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds (BIGINT) -> TIMESTAMP in the session zone."""
    return F.timestamp_millis(_col(c))


def minute_parts(ts: Column | str) -> tuple[Column, Column, Column]:
    """The date (``yyyyMMdd``), hour and minute parts of a minute key."""
    t = _col(ts)
    return (F.date_format(t, DATEKEY_FORMAT), F.date_format(t, "HH"), F.date_format(t, "mm"))


def today() -> Column:
    """today's date as ``yyyy-MM-dd`` (session zone)."""
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    """yesterday's date as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
