"""Which inbound files are new, and what to remember once they are processed.

All of it works on many feeds at once: a listing names the state record (``stateKey``) each
file belongs to, and state is a table of (stateKey, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconfold.functions.expressions import base_name
from beaconfold.schemas import DATED_FILE_PATTERN, FILE_STATE_JSON


def name_state_key(table: Column | str, source_id: Column | int) -> Column:
    """State record of a name feed. Fixed format."""
    table = F.lit(table) if isinstance(table, str) else table
    source = F.lit(source_id) if isinstance(source_id, int) else source_id
    return F.concat(F.lit("name_mappings."), table, F.lit("."), source.cast("string"), F.lit(".latest_processed"))


def file_state_key(files_type: Column | str, key: Column) -> Column:
    """State record of a single file; the folder is not part of it. Fixed format."""
    files_type = F.lit(files_type) if isinstance(files_type, str) else files_type
    return F.concat(files_type, F.lit("."), base_name(key), F.lit(".processed_etag"))


# ---- single files, remembered by etag ---------------------------------------------------


def detect_new_files(listing: DataFrame, state: DataFrame, files_type: Column | str) -> DataFrame:
    """Files without a state record, or whose etag differs from it: (stateKey, key, etag, …)."""
    named = listing.withColumn("stateKey", file_state_key(files_type, F.col("key")))
    known = state.select("stateKey", F.col("value").alias("etag"))
    return named.join(known, ["stateKey", "etag"], "left_anti").select("stateKey", *listing.columns)


def processed_file_state(new_files: DataFrame) -> DataFrame:
    """State records to save for processed files; of files with equal names the last key counts."""
    return new_files.groupBy("stateKey").agg(F.max_by("etag", "key").alias("value"))


# ---- dated feeds, remembered by date and the files of that date ---------------------------


def decode_feed_state(state: DataFrame) -> DataFrame:
    """Feed state records as (stateKey, timestamp, partitions).

    A record is either ``date|etag`` or JSON with the date and the files processed for it.
    """
    legacy = F.split("value", r"[|]")
    parsed = F.from_json("value", FILE_STATE_JSON)
    is_legacy = F.contains("value", F.lit("|"))
    old_partition = F.array(F.struct(F.lit("").alias("filename"), legacy[1].alias("etag")))
    return state.where(F.col("value").isNotNull()).select(
        "stateKey",
        F.when(is_legacy, legacy[0]).otherwise(parsed["timestamp"]).alias("timestamp"),
        F.when(is_legacy, old_partition).otherwise(parsed["partitions"]).alias("partitions"),
    )


def feed_state_files(decoded: DataFrame) -> DataFrame:
    """One row per file a feed state remembers."""
    return decoded.select("stateKey", "timestamp", F.inline("partitions"))


def dated_files(listing: DataFrame, pattern: str = DATED_FILE_PATTERN) -> DataFrame:
    """Files whose key carries a date, with that date as ``timestamp`` text."""
    stamp = F.regexp_extract("key", pattern, 1)
    return listing.where(F.col("key").rlike(pattern)).withColumn("timestamp", stamp)


def select_latest_files(listing: DataFrame, state: DataFrame, pattern: str = DATED_FILE_PATTERN) -> DataFrame:
    """Files to process per feed: of its newest date only, and not processed before.

    Dates compare as text. A feed whose newest date is behind its state has nothing to do.
    Files with equal etag are one file: it is read under its last key and applied at the
    place of its first (``apply_key``).
    """
    dated = dated_files(listing, pattern)
    newest = dated.groupBy("stateKey").agg(F.max("timestamp").alias("timestamp"))
    done = decode_feed_state(state).select("stateKey", F.col("timestamp").alias("_processed"), "partitions")
    is_done = F.coalesce(F.exists("partitions", lambda p: p["etag"] == F.col("etag")), F.lit(False))
    return (
        dated.join(newest, ["stateKey", "timestamp"], "left_semi")
        .groupBy("stateKey", "timestamp", "etag")
        .agg(F.max("key").alias("key"), F.min("key").alias("apply_key"))
        .join(done, "stateKey", "left")
        .where(F.col("_processed").isNull() | (F.col("timestamp") > F.col("_processed")) | ((F.col("timestamp") == F.col("_processed")) & ~is_done))
        .select("stateKey", "timestamp", "key", "etag", "apply_key")
    )


def advance_feed_state(selected: DataFrame, state: DataFrame) -> DataFrame:
    """Files each processed feed now has to remember: (stateKey, timestamp, filename, etag).

    Files of the same date add up; a newer date starts over. Feeds without new files keep
    their record and do not appear.
    """
    new = selected.select("stateKey", "timestamp", base_name(F.col("key")).alias("filename"), "etag")
    kept = feed_state_files(decode_feed_state(state)).join(
        selected.select("stateKey", "timestamp").distinct(), ["stateKey", "timestamp"], "left_semi"
    )
    return new.unionByName(kept)


def encode_feed_state(remembered: DataFrame) -> DataFrame:
    """Remembered files as state records (stateKey, value): one record per feed, as JSON."""
    files = F.array_sort(F.collect_list(F.struct("filename", "etag")))
    return (
        remembered.groupBy("stateKey", "timestamp")
        .agg(files.alias("partitions"))
        .select("stateKey", F.to_json(F.struct("timestamp", "partitions")).alias("value"))
    )


# ---- load notices -----------------------------------------------------------------------


def load_manifest(locations: DataFrame, client_id: str, url: Column) -> DataFrame:
    """One notice per location for the downstream loader."""
    return locations.select(F.lit(client_id).alias("client_id"), url.alias("data_url"))
