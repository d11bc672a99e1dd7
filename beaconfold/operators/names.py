"""Merging identifier/name files into reference tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconfold.schemas import SYSTEM_USER_ID


def last_names(rows: DataFrame, *keys: str) -> DataFrame:
    """The last name given to each id, in order of file and row: columns ``keys`` and ``name``.

    Rows carry ``apply_key`` and ``row_no``. One value per key leaves each map task, so an id
    repeated very often is no burden.
    """
    return rows.groupBy(*keys).agg(F.max_by("name", F.struct("apply_key", "row_no")).alias("name"))


def incoming_names(rows: DataFrame, selected: DataFrame, *scope: str) -> DataFrame:
    """Last names from the rows of the selected files. ``rows`` has key, row_no, id, name."""
    files = selected.select("key", "apply_key", *scope)
    return last_names(rows.join(files, "key"), *scope, "id")


def merge_names(target: DataFrame, incoming: DataFrame, source_id: Column | int, now: datetime) -> DataFrame:
    """Next snapshot of a name table: new ids inserted, known ids renamed, the rest untouched.

    A known id counts as modified even where its name stays the same. ``incoming`` has one
    row per id; a column ``MEASUREMENT_SOURCE_ID`` may be passed as ``source_id``.
    """
    source = F.lit(source_id) if isinstance(source_id, int) else source_id
    at = F.lit(now).cast("timestamp")
    new = incoming.select(
        source.cast("int").alias("MEASUREMENT_SOURCE_ID"),
        F.col("id").alias("ID"),
        F.col("name").alias("_name"),
        F.lit(True).alias("_incoming"),
    )
    inserted = F.col("_incoming") & F.col("_on_record").isNull()
    renamed = F.col("_incoming") & F.col("_on_record")
    merged = {
        "NAME": F.when(F.col("_incoming"), F.col("_name")).otherwise(F.col("NAME")),
        "CREATED_BY": F.when(inserted, SYSTEM_USER_ID).otherwise(F.col("CREATED_BY")),
        "CREATED_ON": F.when(inserted, at).otherwise(F.col("CREATED_ON")),
        "MODIFIED_BY": F.when(renamed, SYSTEM_USER_ID).otherwise(F.col("MODIFIED_BY")),
        "LAST_MODIFIED": F.when(renamed, at).otherwise(F.col("LAST_MODIFIED")),
    }
    return (
        target.withColumn("_on_record", F.lit(True))
        .join(new, ["MEASUREMENT_SOURCE_ID", "ID"], "full_outer")
        .select(*[merged.get(c, F.col(c)).alias(c) for c in target.columns])
    )
