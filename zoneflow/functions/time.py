"""Event time and calendar expressions. The session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column) -> Column:
    """Timestamp of ISO text; NULL for missing, empty or malformed text."""
    return F.try_to_timestamp(text)


def local_time(ts: Column, tz: str | None = None) -> Column:
    """Wall-clock time in ``tz``; UTC when none is named."""
    return ts if tz is None else F.from_utc_timestamp(ts, tz)


def day_type(ts: Column) -> Column:
    """``weekday`` from Monday to Friday, ``weekend`` otherwise; NULL stays NULL."""
    return F.when(F.weekday(ts) < 5, "weekday").when(F.weekday(ts) >= 5, "weekend")
