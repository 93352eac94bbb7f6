"""Epoch, calendar and window-bound expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch; a zone-less timestamp is read as UTC wall time."""
    return F.unix_millis(ts.cast("timestamp"))


def local_time(ms: Column) -> Column:
    """Epoch milliseconds as a zone-less timestamp in the session zone."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def day_of(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def same_day(ms: Column, as_of: str) -> Column:
    return day_of(ms) == F.lit(as_of).cast("date")


def bucket(ms: Column, width_ms: int) -> Column:
    """Number of the fixed-width bucket a time falls into."""
    return F.floor(ms / F.lit(width_ms)).cast("long")


def not_blank(text: Column) -> Column:
    """Neither null, empty nor only white space."""
    return F.coalesce(F.length(F.trim(text)) > 0, F.lit(False))
