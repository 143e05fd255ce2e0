"""Epoch conversion, local time parts and recency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_SHIFT_HOURS = 9


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 (session time zone UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def wall(ts: Column) -> Column:
    """Zone-less UTC wall clock of a timestamp."""
    return ts.cast("timestamp_ntz")


def local_time(ts: Column) -> Column:
    """UTC wall clock moved to UTC+9, as a zone-less timestamp.

    The reference queries re-read UTC wall time as if it were +9, which moves the instant the
    other way; the column names say UTC+9, and that is what this gives.
    """
    return wall(ts) + F.expr(f"INTERVAL '{LOCAL_SHIFT_HOURS}' HOUR")


def local_parts(ts: Column, prefix: str = "interaction", stamp: str | None = None) -> list[Column]:
    """Timestamp, date, hour and weekday (Sunday = 1) in UTC+9."""
    local = local_time(ts)
    return [
        local.alias(stamp or f"{prefix}_datetime_utc9"),
        F.to_date(local).alias(f"{prefix}_date_utc9"),
        F.hour(local).cast("long").alias(f"{prefix}_hour_utc9"),
        F.dayofweek(local).cast("long").alias(f"{prefix}_day_of_week_utc9"),
    ]


def days_between(later: Column, earlier: Column) -> Column:
    """Whole calendar days from earlier to later."""
    return F.date_diff(F.to_date(later), F.to_date(earlier)).cast("long")


def days_until(as_of: str, ts: Column) -> Column:
    """Recency against a given day, so a result can be reproduced later."""
    return days_between(F.lit(as_of).cast("date"), ts)
