"""Date, hour and time-of-day expressions.

Wall-clock times are TIMESTAMP_NTZ throughout, so a result never depends on the
session time zone. Text that is not a timestamp becomes NULL instead of failing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wall_clock(column: str | Column) -> Column:
    """Text or timestamp as TIMESTAMP_NTZ; malformed text is NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return column.try_cast("timestamp_ntz")


def hour_start(column: str | Column) -> Column:
    """The hour a timestamp falls in.

    Built from date and hour: truncation works on instants of the session zone, which
    has no such hour when its clocks go forward.
    """
    at = wall_clock(column)
    return F.timestamp_add("HOUR", F.hour(at), F.to_date(at).cast("timestamp_ntz"))


def hour_label(column: str | Column) -> Column:
    """Time of day of the hour as ``HH:00:00`` text."""
    return F.concat(F.lpad(F.hour(column).cast("string"), 2, "0"), F.lit(":00:00"))


def hour_bucket(df: DataFrame, ts: str = "started_at") -> DataFrame:
    """Adds ``ts_hour``, ``date`` and ``time`` for the hour of ``ts``."""
    return df.withColumn("ts_hour", hour_start(ts)).withColumns(
        {"date": F.to_date("ts_hour"), "time": hour_label("ts_hour")}
    )


def epoch_wall_clock(seconds: str | Column, zone: str = "UTC") -> Column:
    """Epoch seconds (number or text) as wall-clock time in ``zone``."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("SECOND", seconds.try_cast("bigint"), origin)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_parts(df: DataFrame, column: str = "dt", zone: str = "UTC") -> DataFrame:
    """Adds ``ts``, ``date``, ``time`` (``HH:mm:ss``), ``year`` and ``month``."""
    return df.withColumn("ts", epoch_wall_clock(column, zone)).withColumns(
        {
            "date": F.to_date("ts"),
            "time": F.substring_index(F.col("ts").cast("string"), " ", -1),
            "year": F.year("ts"),
            "month": F.month("ts"),
        }
    )


def epoch_text(
    seconds: str | Column, zone: str = "UTC", pattern: str = "yyyy-MM-dd HH:mm:ss"
) -> Column:
    """Epoch seconds as formatted text.

    Only the default pattern is free of the session zone: other ones are formatted as
    instants, so an hour that the session zone skips moves.
    """
    at = epoch_wall_clock(seconds, zone)
    return at.cast("string") if pattern == "yyyy-MM-dd HH:mm:ss" else F.date_format(at, pattern)


def year_month(column: str | Column, padded: bool = True) -> Column:
    """``2021-03``, which sorts by time; ``padded=False`` gives ``2021-3``."""
    year, month = F.year(column).cast("string"), F.month(column).cast("string")
    if padded:
        year, month = F.lpad(year, 4, "0"), F.lpad(month, 2, "0")
    return F.concat(year, F.lit("-"), month)


def day_name(column: str | Column) -> Column:
    return F.date_format(F.to_date(column), "EEEE")


def hour_text(date: str | Column, hour: str | Column) -> Column:
    """Date and hour number as ``yyyy-MM-dd HH:00:00`` text."""
    return F.concat(F.to_date(date).cast("string"), F.format_string(" %02d:00:00", hour))


def hour_of_time(time: str | Column) -> Column:
    """Hour part of ``HH:MM:SS`` text, still text."""
    return F.split_part(time if isinstance(time, Column) else F.col(time), F.lit(":"), F.lit(1))


def is_dayoff(
    date: str | Column,
    first_year: int | None = None,
    last_year: int | None = None,
    holidays: Iterable[dt.date] = (),
) -> Column:
    """True on Saturdays and Sundays and on listed holidays.

    ``first_year`` and ``last_year`` bound the weekends, each only if given. A NULL
    date is false.
    """
    date = F.col(date) if isinstance(date, str) else date
    off = F.weekday(date) >= 5
    if first_year is not None:
        off = off & (F.year(date) >= first_year)
    if last_year is not None:
        off = off & (F.year(date) <= last_year)
    holidays = list(holidays)
    if holidays:
        off = off | date.isin(holidays)
    return F.coalesce(off, F.lit(False))


def as_of_hour(now: dt.datetime | None = None, offset_hours: int = -4) -> dt.datetime:
    """Current hour at a fixed UTC offset, without zone. ``now`` must be aware."""
    zone = dt.timezone(dt.timedelta(hours=offset_hours))
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(zone).replace(minute=0, second=0, microsecond=0, tzinfo=None)


def wall_clock_literal(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
