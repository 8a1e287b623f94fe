"""Date and time Column helpers.

All work on ``timestamp_ntz`` (wall-clock) values without going through
the session time zone, except the ``date_format`` based keys, which are
stable because the session time zone is pinned to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text formats of the analysed application.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _floor_div(x: Column, n: int) -> Column:
    """Integer division rounding toward minus infinity (exact on bigint)."""
    return F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp_ntz (no time zone),
    rounded down (also before 1970)."""
    return _floor_div(F.timestamp_diff("MICROSECOND", _epoch(), _col(ts)), 1_000_000)


def epoch_minutes(ts: Column | str) -> Column:
    return _floor_div(F.timestamp_diff("MICROSECOND", _epoch(), _col(ts)), 60_000_000)


def from_epoch_seconds(seconds: Column | str) -> Column:
    """timestamp_ntz from whole seconds since 1970-01-01."""
    return F.timestamp_add("SECOND", _col(seconds), _epoch())


def truncate_to_second(ts: Column | str) -> Column:
    """Drop the fraction of a second and keep the timestamp_ntz type
    (``date_trunc`` would return a session-zone timestamp)."""
    return from_epoch_seconds(epoch_seconds(ts))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """end - start in whole seconds (both already truncated to seconds)."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


# Leading "y-M-d H:m:s" with any number of digits per field; what follows
# is ignored, as Java's DateFormat.parse(String) ignores trailing text.
_TIME_PREFIX = r"^\d{1,4}-\d+-\d+ \d+:\d+:\d+"  # years 0..9999
# Single-letter fields read any number of digits ("9", "09", "009").
_LENIENT_TIME_FORMAT = "y-M-d H:m:s"


def parse_time(text: Column | str) -> Column:
    """Time text -> timestamp; NULL on bad text.

    Reads like the application's ``yyyy-MM-dd HH:mm:ss`` parser: fields
    may be unpadded ("2018-02-07 9:05:03") and trailing text is ignored.
    Out-of-range fields ("25:61:61") give NULL instead of rolling over.
    One regex pass cuts the leading time, one parse reads it.
    """
    # No nullif here: it would bind a per-call common expression and stop
    # Spark from sharing one parse between helpers; "" parses to NULL.
    head = F.regexp_extract(_col(text), _TIME_PREFIX, 0)
    return F.try_to_timestamp(head, F.lit(_LENIENT_TIME_FORMAT))


def parse_date_key(text: Column | str) -> Column:
    """``yyyyMMdd`` text -> date from its first 8 digits (trailing text is
    ignored, as by the application's parser); NULL on bad text."""
    return F.try_to_date(F.regexp_extract(_col(text), r"^\d{8}", 0), DATE_KEY_FORMAT)


def is_before(t1: Column | str, t2: Column | str) -> Column:
    """True when time text t1 is before t2; false when either is bad."""
    return F.coalesce(parse_time(t1) < parse_time(t2), F.lit(False))


def is_after(t1: Column | str, t2: Column | str) -> Column:
    return F.coalesce(parse_time(t1) > parse_time(t2), F.lit(False))


def minus_seconds(t1: Column | str, t2: Column | str) -> Column:
    """Seconds of t1 - t2 for time text; 0 on bad text or when the
    difference does not fit in a 32-bit int."""
    return int_or_zero(F.unix_seconds(parse_time(t1)) - F.unix_seconds(parse_time(t2)))


def int_or_zero(diff: Column) -> Column:
    """A number that fits in a 32-bit int, else 0 (as NULL does)."""
    fits = diff.between(-(2**31), 2**31 - 1)
    return F.when(fits, diff).otherwise(F.lit(0).cast("bigint"))


def date_hour_key(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``yyyy-MM-dd_HH`` by splitting the text
    (no parsing and no padding: an unpadded hour stays unpadded)."""
    t = _col(text)
    day = F.split_part(t, F.lit(" "), F.lit(1))
    hour = F.split_part(F.split_part(t, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))
    return F.concat(day, F.lit("_"), hour)


def format_date(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE_FORMAT)


def format_time(c: Column | str) -> Column:
    return F.date_format(_col(c), TIME_FORMAT)


def format_date_key(c: Column | str) -> Column:
    return F.date_format(_col(c), DATE_KEY_FORMAT)


def format_minute_key(c: Column | str) -> Column:
    return F.date_format(_col(c), MINUTE_KEY_FORMAT)


def previous_day(d: Column | str) -> Column:
    return F.date_sub(_col(d), 1)
