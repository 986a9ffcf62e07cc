"""Column expressions for UTC time handling."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc(value: datetime | None) -> datetime | None:
    """Read naive datetimes as UTC and move aware ones to UTC."""
    if value is None:
        return None
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def micros(value: datetime) -> int:
    """Microseconds since the epoch, exact."""
    since = utc(value) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


def as_of_column(as_of: datetime | Column | None) -> Column:
    """The evaluation instant: a given value, or the query's own current timestamp."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(utc(as_of))


def epoch_ms_to_second(millis: Column) -> Column:
    """Millisecond epoch to timestamp, cut down to the whole second; null stays null."""
    return F.timestamp_seconds(F.floor(millis.try_cast("bigint") / F.lit(1000)))


def utc_date(moment: str | Column) -> Column:
    """UTC date of a timestamp, whatever the session's time zone."""
    column = F.col(moment) if isinstance(moment, str) else moment
    return F.date_from_unix_date(F.floor(F.unix_seconds(column) / F.lit(86_400)).cast("int"))


def age_minutes(as_of: Column, moment: Column) -> Column:
    """Whole-second difference in minutes, two decimals."""
    return F.round((F.unix_seconds(as_of) - F.unix_seconds(moment)) / F.lit(60.0), 2)
