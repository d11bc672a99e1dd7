"""Raw partner events and stored ad sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.functions.calendar import in_data_day
from beaconfold.functions.expressions import nodash
from beaconfold.profiles import PartnerProfile
from beaconfold.schemas import RAW_EVENTS, SESSIONS
from beaconfold.sources.days import day_folder

ORDER = "event_seq"


def read_events(
    spark: SparkSession,
    profile: PartnerProfile,
    *,
    database: str | None = None,
    path: str | None = None,
    utcdates: Sequence[str] | None = None,
) -> DataFrame:
    """A partner's raw events, from catalog table ``database.<partner>`` or a parquet directory.

    A directory is read with the declared schema: inference would turn the ``utcdate`` and
    ``utchour`` partition values into integers and lose the leading zeros.
    """
    if (database is None) == (path is None):
        raise ValueError("give either a database or a path")
    if database is not None:
        return spark.table(f"{database}.{profile.name}")
    schema = RAW_EVENTS
    if profile.event_order is not None:
        schema = T.StructType([*RAW_EVENTS.fields, T.StructField(profile.event_order, T.LongType())])
    if utcdates is None:
        return spark.read.schema(schema).parquet(path)
    # Only these dates' folders are listed.
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/utcdate={{{','.join(utcdates)}}}")


def canonical_events(raw: DataFrame, profile: PartnerProfile) -> DataFrame:
    """Raw events under canonical names, with the absent channel dimension and, if the profile has one, its order column.

    Without, no order is made here: those who need one make it of the columns they read (``dedupe_events``, ``session_facts``).
    """
    added = {"partner_measured_channel_id": F.lit(None).cast("bigint")}
    if profile.event_order is not None:
        added[ORDER] = F.col(profile.event_order)
    return raw.withColumns(added).withColumnsRenamed(dict(profile.renames))


def day_events(
    raw: DataFrame, profile: PartnerProfile, data_date: str, tz_offset: int, hours: int = 24
) -> DataFrame:
    """Canonical events of one data day."""
    return canonical_events(raw.where(in_data_day(data_date, tz_offset, hours)), profile)


def read_sessions(spark: SparkSession, path: str, data_date: str, file_format: str = "parquet") -> DataFrame:
    """Stored sessions of one day: its committed version, by ``hour=…``. No other date is listed."""
    stored = T.StructType([f for f in SESSIONS.fields if f.name != "date"])
    day = spark.read.format(file_format).schema(stored).load(day_folder(spark, path, data_date))
    return day.withColumn("date", F.lit(nodash(data_date))).select(*SESSIONS.names)


def read_session_table(spark: SparkSession, table: str, data_date: str) -> DataFrame:
    """Stored sessions of one day from the catalog, where the partition keys are ``estdate``/``esthour``."""
    stored = spark.table(table).where(F.col("estdate") == nodash(data_date))
    return stored.withColumnsRenamed({"estdate": "date", "esthour": "hour"}).select(*SESSIONS.names)
