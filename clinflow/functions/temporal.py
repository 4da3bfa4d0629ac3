"""Instants, dates and durations."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinflow.functions.numeric import round_bin


def parse_instant(text: Column) -> Column:
    """ISO 8601 text -> timestamp; malformed text gives NULL."""
    return F.try_to_timestamp(text)


def parse_date(text: Column) -> Column:
    """The written date part, whatever the offset; malformed text gives NULL."""
    return text.try_cast("date")


def epoch(ts: Column) -> Column:
    """Seconds since 1970 with fraction."""
    return ts.cast("timestamp").cast("double")


def gap_seconds(later: Column, earlier: Column) -> Column:
    return epoch(later) - epoch(earlier)


def los_hours(start: Column, end: Column) -> Column:
    """Length of stay at ingest: whole seconds, two decimals."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(3600.0), 2)


def episode_hours(start: Column, end: Column) -> Column:
    """Seconds are rounded, the quotient is not."""
    return round_bin(gap_seconds(end, start)) / F.lit(3600.0)


def wall_clock(ts: Column, tz: str) -> Column:
    """Local date and time of an instant in ``tz``, whatever the session time zone is: counted from
    1970 in UTC, since a cast would merge the two hours of the session zone's autumn change."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(ts.cast("timestamp")), start)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def month_start(ts: Column, tz: str) -> Column:
    """First day of the month, as a date in ``tz``."""
    return F.trunc(wall_clock(ts, tz).cast("date"), "month")
