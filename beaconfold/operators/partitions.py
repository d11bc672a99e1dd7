"""Partition bookkeeping: completeness of sources, registration and expiry of outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from beaconfold.functions.calendar import expected_hours


def missing_source_hours(dates: DataFrame, present: DataFrame, **day: object) -> DataFrame:
    """Hours of each ``data_date`` that have no source partition yet; a complete day has none.

    ``present`` lists existing (utcdate, utchour), once or more. ``day`` goes to
    :func:`~beaconfold.functions.calendar.expected_hours`.
    """
    return expected_hours(dates, **day).join(present, ["utcdate", "utchour"], "left_anti").select(
        *dates.columns, "utcdate", "utchour"
    )


def day_partitions(dates: DataFrame, day_path: Column, by_hour: bool) -> DataFrame:
    """The catalog partitions of each ``estdate`` (``yyyyMMdd`` text) and where they belong: (estdate[, esthour], location).

    With ``by_hour`` all 24 hours of a date are wanted, whether they hold data or not.
    """
    if not by_hour:
        return dates.select("estdate", day_path.alias("location"))
    hours = F.array(*[F.lit(f"{h:02d}") for h in range(24)])
    each = dates.select("estdate", day_path.alias("_day"), F.explode(hours).alias("esthour"))
    return each.select("estdate", "esthour", F.concat("_day", F.lit("/hour="), F.col("esthour")).alias("location"))


def partitions_to_register(dates: DataFrame, existing: DataFrame, location: Column | str, by_hour: bool) -> DataFrame:
    """Catalog partitions to add for each ``estdate`` in the layout ``date=…[/hour=…]`` below a location."""
    location = F.lit(location) if isinstance(location, str) else location
    wanted = day_partitions(dates, F.concat(location, F.lit("date="), F.col("estdate")), by_hour)
    return wanted.join(existing, [c for c in wanted.columns if c != "location"], "left_anti").select(wanted.columns)


def expired_partitions(dates: DataFrame, as_of: Column, keep_days: Mapping[str, int]) -> DataFrame:
    """Partition dates (column ``date``) beyond the retention of each kind of table: (kind, keep_days, date)."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(d).alias("keep_days")) for k, d in keep_days.items()])
    return dates.select(F.inline(kinds), "date").where(F.col("date") < F.date_sub(as_of, F.col("keep_days")))


def _text(value: str) -> str:
    """A value as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_partitions(spark: SparkSession, table: str, of: tuple[str, str] | None = None) -> DataFrame:
    """Partitions the catalog knows for a table, one string column per partition key. Reads no data.

    ``of`` (key, value) asks the catalog for the partitions below that one only.
    """
    only = f" PARTITION ({of[0]} = {_text(of[1])})" if of else ""
    listed = spark.sql(f"SHOW PARTITIONS {table}{only}")
    keys = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return listed.select(*[F.regexp_extract("partition", rf"(?:^|/){k}=([^/]*)", 1).alias(k) for k in keys])


def _partition(row: Row, keys: Sequence[str]) -> str:
    return "PARTITION (" + ", ".join(f"{k} = {_text(row[k])}" for k in keys) + ")"


def register_partitions(spark: SparkSession, table: str, plan: DataFrame) -> int:
    """Add planned partitions to the catalog; those it already has are left alone.

    The plan has one row per date or hour to add, so it is small enough for the driver.
    """
    keys = [c for c in plan.columns if c != "location"]
    rows = plan.collect()
    if rows:
        parts = " ".join(f"{_partition(row, keys)} LOCATION {_text(row['location'])}" for row in rows)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    return len(rows)


def move_partitions(spark: SparkSession, table: str, plan: DataFrame) -> None:
    """Point partitions the catalog has to other locations, one after another.

    The plan has one row per date or hour of a rewritten day. A reader in between meets some hours of the old version, which is
    kept, and some of the new one, each of them whole.
    """
    keys = [c for c in plan.columns if c != "location"]
    for row in plan.collect():
        spark.sql(f"ALTER TABLE {table} {_partition(row, keys)} SET LOCATION {_text(row['location'])}")
