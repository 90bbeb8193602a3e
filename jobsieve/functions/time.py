"""Run ids and the daily schedule."""

from __future__ import annotations

from datetime import UTC, date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# The schedule.
ZONE, AT = "America/New_York", time(10, 0)
FORMAT = "%Y%m%dT%H%M%SZ"


def run_id(as_of: datetime, suffix: str = "") -> str:
    """The id of a run, computed once on the driver: its UTC instant, and a suffix for runs of another kind."""
    if as_of.tzinfo is None:
        raise ValueError("as_of needs a time zone")
    return as_of.astimezone(UTC).strftime(FORMAT) + (f"-{suffix}" if suffix else "")


def parse_run_id(value: str) -> tuple[datetime, str]:
    stamp, _, suffix = value.partition("-")
    return datetime.strptime(stamp, FORMAT).replace(tzinfo=UTC), suffix


def due(day: date) -> datetime:
    """The UTC instant of the run of a day."""
    return datetime.combine(day, AT, ZoneInfo(ZONE)).astimezone(UTC)


def next_due(now: datetime) -> datetime:
    """The first scheduled instant after now."""
    day = now.astimezone(ZoneInfo(ZONE)).date()
    return next(x for x in (due(day), due(day + timedelta(days=1))) if x > now)


def run_day(ts: Column) -> Column:
    """The New York day whose 10:00 to 10:00 a UTC timestamp falls in."""
    return F.to_date(F.from_utc_timestamp(ts, ZONE) - F.expr("interval 10 hours"))


def due_utc(day: Column) -> Column:
    """The UTC instant of 10:00 New York on a day."""
    return F.to_utc_timestamp(F.to_date(day).cast("timestamp") + F.expr("interval 10 hours"), ZONE)


def run_id_of(ts: Column) -> Column:
    """``run_id`` of a UTC timestamp, as a column."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
