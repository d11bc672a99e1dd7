"""The daily viewability run: sessions, mart, partitions, load notice."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.functions.calendar import day_hours, utc_offset_seconds, utc_windows
from beaconfold.functions.expressions import nodash
from beaconfold.operators.files import load_manifest
from beaconfold.operators.mart import daily_mart
from beaconfold.operators.partitions import (
    day_partitions,
    missing_source_hours,
    move_partitions,
    register_partitions,
    table_partitions,
)
from beaconfold.operators.sessions import ad_sessions
from beaconfold.profiles import PartnerProfile, select_profiles
from beaconfold.sinks.tables import write_mart, write_sessions
from beaconfold.sources.days import day_folder
from beaconfold.sources.events import day_events, read_events, read_sessions
from beaconfold.sources.files import list_partition_hours


Result = TypeVar("Result")


class SourceIncomplete(Exception):
    """Some hours of the data day have not arrived."""

    def __init__(self, partner: str, missing: list[tuple[str, str]]):
        super().__init__(f"{partner}: no source data for {', '.join(f'{d} {h}' for d, h in missing)}")
        self.missing = missing


@dataclass(frozen=True)
class Warehouse:
    """Where a deployment keeps its data; partner names are appended to the roots.

    Raw events come from ``raw_database`` or from ``raw_root``. ``session_database`` and
    ``mart_database`` name catalogs in which output partitions get registered, if given.
    """

    session_root: str
    mart_root: str
    raw_database: str | None = None
    raw_root: str | None = None
    session_database: str | None = None
    mart_database: str | None = None
    session_format: str = "parquet"
    client_id: str = "ad-sessions"
    site_mart: bool = False


def raw_source(
    spark: SparkSession, profile: PartnerProfile, warehouse: Warehouse, utcdates: Sequence[str] | None = None
) -> DataFrame:
    """Raw events; of a directory, only the given UTC dates' folders are listed."""
    if warehouse.raw_database is not None:
        return read_events(spark, profile, database=warehouse.raw_database)
    return read_events(spark, profile, path=f"{warehouse.raw_root}/{profile.name}", utcdates=utcdates)


def check_complete(
    spark: SparkSession, profile: PartnerProfile, warehouse: Warehouse, data_date: str, tz_offset: int, hours: int
) -> None:
    """Raise unless every hour of the data day has a source partition. Looks at partition names only."""
    utcdates = [d for d, _, _ in utc_windows(data_date, tz_offset, hours)]
    if warehouse.raw_database is not None:
        table = f"{warehouse.raw_database}.{profile.name}"
        present = reduce(DataFrame.unionByName, [table_partitions(spark, table, ("utcdate", d)) for d in utcdates])
    else:
        present = list_partition_hours(spark, f"{warehouse.raw_root}/{profile.name}", utcdates)
    day = spark.range(1).select(F.lit(data_date).cast("date").alias("data_date"))
    if hours == 24:
        missing = missing_source_hours(day, present, tz_offset=tz_offset)
    else:
        missing = missing_source_hours(day, present, day_mode="calendar")
    gaps = missing.orderBy("utcdate", "utchour").collect()  # one data day: 25 rows at most
    if gaps:
        raise SourceIncomplete(profile.name, [(g["utcdate"], g["utchour"]) for g in gaps])


def build_sessions(
    spark: SparkSession, profile: PartnerProfile, warehouse: Warehouse, data_date: str, tz_offset: int, hours: int = 24
) -> None:
    """Fold one data day and write its session partitions."""
    utcdates = [d for d, _, _ in utc_windows(data_date, tz_offset, hours)]
    events = day_events(raw_source(spark, profile, warehouse, utcdates), profile, data_date, tz_offset, hours)
    sessions = ad_sessions(events, profile, data_date, tz_offset)
    write_sessions(sessions, f"{warehouse.session_root}/{profile.name}", data_date, warehouse.session_format)


def build_mart(spark: SparkSession, profile: PartnerProfile, warehouse: Warehouse, data_date: str) -> None:
    """Roll up one stored session day and write its mart partition, and the per-site one if wanted."""
    root = f"{warehouse.session_root}/{profile.name}"
    sessions = read_sessions(spark, root, data_date, warehouse.session_format)
    write_mart(daily_mart(sessions), f"{warehouse.mart_root}/{profile.name}", data_date)
    if warehouse.site_mart:
        write_mart(daily_mart(sessions, ("site",)), f"{warehouse.mart_root}/{profile.name}_site", data_date)


def register_day(spark: SparkSession, table: str, root: str, data_date: str, *, by_hour: bool) -> int:
    """Have the catalog's partitions of one date point to the day's committed version; returns how many were new."""
    day = spark.range(1).select(F.lit(nodash(data_date)).alias("estdate"))
    wanted = day_partitions(day, F.lit(day_folder(spark, root, data_date)), by_hour)
    keys = [c for c in wanted.columns if c != "location"]
    existing = table_partitions(spark, table, ("estdate", nodash(data_date)))
    move_partitions(spark, table, wanted.join(existing, keys, "left_semi"))
    return register_partitions(spark, table, wanted.join(existing, keys, "left_anti"))


def run_day(
    spark: SparkSession,
    profile: PartnerProfile,
    warehouse: Warehouse,
    data_date: str,
    *,
    tz_offset: int | None = None,
    day_mode: str = "fixed24",
) -> DataFrame:
    """One partner's day from raw events to mart; returns the load notices to send."""
    if tz_offset is not None and day_mode == "calendar":
        raise ValueError("calendar days need the zone, not an offset")
    tz_offset = utc_offset_seconds(data_date) if tz_offset is None else tz_offset
    hours = day_hours(data_date, day_mode)
    check_complete(spark, profile, warehouse, data_date, tz_offset, hours)

    build_sessions(spark, profile, warehouse, data_date, tz_offset, hours)
    if warehouse.session_database is not None:
        root = f"{warehouse.session_root}/{profile.name}"
        register_day(spark, f"{warehouse.session_database}.{profile.name}", root, data_date, by_hour=True)

    build_mart(spark, profile, warehouse, data_date)
    tables = [profile.name, f"{profile.name}_site"] if warehouse.site_mart else [profile.name]
    if warehouse.mart_database is not None:
        for name in tables:
            root = f"{warehouse.mart_root}/{name}"
            register_day(spark, f"{warehouse.mart_database}.{name}", root, data_date, by_hour=False)

    urls = [day_folder(spark, f"{warehouse.mart_root}/{name}", data_date) + "/" for name in tables]
    locations = spark.range(1).select(F.explode(F.array(*[F.lit(u) for u in urls])).alias("url"))
    return load_manifest(locations, warehouse.client_id, F.col("url"))


class PartnerRunsFailed(ExceptionGroup):
    """Some partners' runs failed; ``done`` has what the others returned, by partner."""

    done: dict[str, object] = {}

    def derive(self, excs: Sequence[Exception]) -> PartnerRunsFailed:
        group = PartnerRunsFailed(self.message, excs)
        group.done = self.done
        return group


def run_days(
    spark: SparkSession, warehouse: Warehouse, data_date: str, partners: Iterable[str] | None = None, **day: object
) -> dict[str, DataFrame]:
    """The daily run for the partners named, or for all of them, side by side; the load notices by partner."""
    profiles = select_profiles(None if partners is None else list(partners))
    return for_each_partner(profiles, lambda profile: run_day(spark, profile, warehouse, data_date, **day))


def for_each_partner(profiles: Iterable[PartnerProfile], run: Callable[[PartnerProfile], Result], at_once: int = 4) -> dict[str, Result]:
    """Run every partner, several at a time on the one session, so that one's narrow stages fill up with another's tasks.

    A partner that fails keeps none of the others from running. Afterwards a partner that ran alone raises its own error, several
    raise a ``PartnerRunsFailed`` with all errors, each with its partner as a note.
    """
    profiles = list(profiles)
    done: dict[str, Result] = {}
    failed: list[Exception] = []
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(profiles)))) as pool:
        own_thread = inheritable_thread_target(SparkSession.active())
        running = [(p, pool.submit(own_thread(run), p)) for p in profiles]
        for profile, future in running:
            try:
                done[profile.name] = future.result()
            except Exception as e:
                e.add_note(f"partner {profile.name}")
                failed.append(e)
    if failed and len(profiles) == 1:
        raise failed[0]
    if failed:
        group = PartnerRunsFailed(f"{len(failed)} of {len(profiles)} partner runs failed", failed)
        group.done = done
        raise group
    return done
