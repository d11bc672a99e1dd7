from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from beaconfold.functions.calendar import (
    day_hours,
    day_windows,
    expected_hours,
    in_data_day,
    utc_offset_seconds,
    utc_windows,
)

NEW_YORK = ZoneInfo("America/New_York")
# An ordinary day, both clock changes and the days after them.
DAYS = ("2024-01-15", "2024-03-10", "2024-03-11", "2024-11-03", "2024-11-04")


def utc_hours(day, hours=24, offset=None):
    """The UTC hours of a data day, one by one."""
    zone = NEW_YORK if offset is None else timezone(timedelta(seconds=offset))
    start = datetime.fromisoformat(day).replace(tzinfo=zone).astimezone(timezone.utc)
    return [(f"{t:%Y%m%d}", f"{t:%H}") for t in (start + timedelta(hours=h) for h in range(hours))]


def test_offset_is_that_of_local_midnight():
    assert [utc_offset_seconds(d) for d in DAYS] == [-18000, -18000, -14400, -14400, -18000]
    assert utc_offset_seconds("2024-07-01", "Asia/Kolkata") == 19800


@pytest.mark.parametrize("mode, want", [("fixed24", [24] * 5), ("calendar", [24, 23, 24, 25, 24])])
def test_day_length(mode, want):
    assert [day_hours(d, mode) for d in DAYS] == want


def test_unknown_day_mode():
    with pytest.raises(ValueError):
        day_hours("2024-01-15", "lunar")


@pytest.mark.parametrize("day", DAYS)
@pytest.mark.parametrize("offset", [None, 0, 19800, -12600])
def test_windows_cover_exactly_the_hours(day, offset):
    seconds = utc_offset_seconds(day) if offset is None else offset
    covered = [
        (d, f"{h:02d}") for d, first, last in utc_windows(day, seconds) for h in range(int(first), int(last) + 1)
    ]
    assert covered == utc_hours(day, offset=offset)


def test_fixed_days_overlap_in_spring_and_leave_a_gap_in_autumn():
    hours = {d: set(utc_hours(d)) for d in DAYS}
    assert hours["2024-03-10"] & hours["2024-03-11"] == {("20240311", "04")}
    assert ("20241104", "04") not in hours["2024-11-03"] | hours["2024-11-04"]
    gap = {("20241104", "04")}
    calendar = {(d, f"{h:02d}") for d, a, b in utc_windows("2024-11-03", -14400, 25) for h in range(int(a), int(b) + 1)}
    assert calendar == hours["2024-11-03"] | gap


@pytest.fixture(scope="module")
def dates(spark):
    return spark.createDataFrame([(date.fromisoformat(d),) for d in DAYS], "data_date date").repartition(2)


@pytest.mark.parametrize("mode", ["fixed24", "calendar"])
def test_expected_hours_by_zone(dates, mode):
    got = {}
    for r in expected_hours(dates, day_mode=mode).collect():
        got.setdefault(r["data_date"].isoformat(), []).append((r["utcdate"], r["utchour"]))
    assert {d: sorted(h) for d, h in got.items()} == {d: sorted(utc_hours(d, day_hours(d, mode))) for d in DAYS}


@pytest.mark.parametrize("mode", ["fixed24", "calendar"])
def test_column_windows_equal_scalar_windows(dates, mode):
    got = {(r[0].isoformat(), *r[1:]) for r in day_windows(dates, day_mode=mode).collect()}
    want = {(d, *w) for d in DAYS for w in utc_windows(d, utc_offset_seconds(d), day_hours(d, mode))}
    assert got == want
    got = {(r[0].isoformat(), *r[1:]) for r in day_windows(dates, tz_offset=19800).collect()}
    assert got == {(d, *w) for d in DAYS for w in utc_windows(d, 19800)}


def test_calendar_days_need_a_zone(dates):
    with pytest.raises(ValueError):
        day_windows(dates, tz_offset=0, day_mode="calendar")


def test_day_predicate(spark):
    hours = utc_hours("2024-01-14", 72)
    frame = spark.createDataFrame(hours, "utcdate string, utchour string")
    got = [tuple(r) for r in frame.where(in_data_day("2024-01-15", -18000)).orderBy("utcdate", "utchour").collect()]
    assert got == utc_hours("2024-01-15")
    assert frame.where(~in_data_day("2024-01-15", -18000)).select(F.count("*")).first()[0] == 48
