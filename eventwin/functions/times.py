"""Time columns as integer microseconds, and time building from parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOUR = 3_600_000_000  # microseconds


def time_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch (UTC) of a DATE, TIMESTAMP or TIMESTAMP_NTZ column."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if not isinstance(kind, (T.TimestampNTZType, T.DateType)):
        raise TypeError(f"column '{name}' is {kind.simpleString()}, expected a date or timestamp")
    instant = F.col(name).cast("timestamp")
    if df.sparkSession.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        # zone-less clock readings count as UTC whatever the session zone is
        instant = F.from_utc_timestamp(instant, F.current_timezone())
    return F.unix_micros(instant)


def from_year_day(year: Column, day: Column, hour: Column, minute: Column) -> Column:
    """Timestamp from year, day of year (1 = 1 January), hour and minute; numbers out of range give null."""
    zero, whole = F.lit(0), lambda c: c.try_cast("int")
    start = F.unix_micros(F.try_make_timestamp(whole(year), F.lit(1), F.lit(1), zero, zero, zero.cast("decimal(8,6)")))
    minutes = F.try_add(F.try_multiply(F.try_add(F.try_multiply(whole(day).cast("bigint") - 1, F.lit(24)), whole(hour)), F.lit(60)), whole(minute))
    return F.timestamp_micros(start + minutes * F.lit(60_000_000))


def from_date_and_hours(year: Column, month: Column, day: Column, hours: Column) -> Column:
    """Timestamp from a calendar date plus fractional hours; impossible dates and hours give null."""
    zero = F.lit(0)
    midnight = F.unix_micros(F.try_make_timestamp(*(c.try_cast("int") for c in (year, month, day)), zero, zero,
                                                  zero.cast("decimal(8,6)")))
    # no instant that a timestamp can hold is as many hours away
    near = F.when(F.abs(hours) < 1e8, hours)
    return F.timestamp_micros(midnight + F.round(near * F.lit(float(HOUR))).cast("bigint"))


def minutes_between(df: DataFrame, begin: str, end: str) -> Column:
    """Length of [begin, end] in minutes."""
    return (time_micros(df, end) - time_micros(df, begin)) / F.lit(60_000_000.0)
