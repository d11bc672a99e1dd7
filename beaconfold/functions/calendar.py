"""The local data day against UTC date/hour partitions.

A data day starts at local midnight. With ``fixed24`` it always spans 24 UTC hours, so on
days of a clock change one hour belongs to two days or to none; with ``calendar`` it spans
the 23, 24 or 25 hours up to the next local midnight.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconfold.schemas import DATA_DATE_ZONE

HOUR_SECONDS = 3600


def utc_offset_seconds(data_date: str, zone: str = DATA_DATE_ZONE) -> int:
    """UTC offset in force at local midnight of the data date."""
    return round(_midnight(data_date, zone).utcoffset().total_seconds())


def _midnight(data_date: str, zone: str) -> datetime:
    return datetime.fromisoformat(data_date).replace(tzinfo=ZoneInfo(zone))


def day_hours(data_date: str, day_mode: str = "fixed24", zone: str = DATA_DATE_ZONE) -> int:
    """Number of UTC hours in the data day."""
    if day_mode == "fixed24":
        return 24
    if day_mode != "calendar":
        raise ValueError(f"day_mode must be 'fixed24' or 'calendar', not {day_mode!r}")
    following = (datetime.fromisoformat(data_date) + timedelta(days=1)).date().isoformat()
    start, end = (_midnight(d, zone).astimezone(timezone.utc) for d in (data_date, following))
    return int((end - start).total_seconds()) // HOUR_SECONDS


def utc_windows(data_date: str, tz_offset: int, hours: int = 24) -> list[tuple[str, str, str]]:
    """``(utcdate, first_hour, last_hour)`` for each UTC date the data day touches."""
    start = datetime.fromisoformat(data_date) - timedelta(seconds=tz_offset)
    last = start + timedelta(hours=hours - 1)
    dates = [start.date() + timedelta(days=n) for n in range((last.date() - start.date()).days + 1)]
    return [
        (
            f"{d:%Y%m%d}",
            f"{start:%H}" if d == start.date() else "00",
            f"{last:%H}" if d == last.date() else "23",
        )
        for d in dates
    ]


def in_data_day(data_date: str, tz_offset: int, hours: int = 24) -> Column:
    """Predicate on the ``utcdate``/``utchour`` partition columns; prunes partitions."""
    return reduce(
        Column.__or__,
        [
            (F.col("utcdate") == day) & F.col("utchour").between(first, last)
            for day, first, last in utc_windows(data_date, tz_offset, hours)
        ],
    )


def _start_and_hours(zone: str | None, tz_offset: int | None, day_mode: str) -> tuple[Column, Column]:
    """First UTC hour (as zone-less timestamp) and number of hours of ``data_date``."""
    midnight = F.col("data_date").cast("timestamp_ntz")
    if tz_offset is not None:
        if day_mode == "calendar":
            raise ValueError("calendar days need a zone, not an offset")
        return midnight - F.make_dt_interval(secs=F.lit(tz_offset)), F.lit(24)
    to_utc = [
        F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))
        for day in (F.col("data_date"), F.date_add("data_date", 1))
    ]
    if day_mode == "fixed24":
        return to_utc[0], F.lit(24)
    return to_utc[0], F.timestamp_diff("HOUR", to_utc[0], to_utc[1]).cast("int")


def expected_hours(
    dates: DataFrame, *, zone: str | None = DATA_DATE_ZONE, tz_offset: int | None = None, day_mode: str = "fixed24"
) -> DataFrame:
    """One row ``(…, utcdate, utchour)`` per UTC hour of each row's ``data_date`` (a date column)."""
    start, hours = _start_and_hours(zone, tz_offset, day_mode)
    return (
        dates.select("*", start.alias("_start"), F.explode(F.sequence(F.lit(0), hours - 1)).alias("_n"))
        .withColumn("_hour", F.col("_start") + F.make_dt_interval(hours=F.col("_n")))
        .select(
            *dates.columns,
            F.date_format("_hour", "yyyyMMdd").alias("utcdate"),
            F.date_format("_hour", "HH").alias("utchour"),
        )
    )


def day_windows(
    dates: DataFrame, *, zone: str | None = DATA_DATE_ZONE, tz_offset: int | None = None, day_mode: str = "fixed24"
) -> DataFrame:
    """``(…, utcdate, first_hour, last_hour)`` for each ``data_date``; no shuffle.

    The column counterpart of :func:`utc_windows`, for many dates at once.
    """
    start, hours = _start_and_hours(zone, tz_offset, day_mode)
    last = F.col("_start") + F.make_dt_interval(hours=F.col("_hours") - 1)
    first_day, last_day = (c.cast("date") for c in (F.col("_start"), F.col("_last")))
    return (
        dates.select("*", start.alias("_start"), hours.alias("_hours"))
        .withColumn("_last", last)
        .withColumn("_day", F.explode(F.sequence(first_day, last_day)))
        .select(
            *dates.columns,
            F.date_format("_day", "yyyyMMdd").alias("utcdate"),
            F.when(F.col("_day") == first_day, F.date_format("_start", "HH")).otherwise("00").alias("first_hour"),
            F.when(F.col("_day") == last_day, F.date_format("_last", "HH")).otherwise("23").alias("last_hour"),
        )
    )
