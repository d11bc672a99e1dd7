"""Runs that keep the reference tables up to date: campaign mappings, names, and new-file notices."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.functions.calendar import utc_offset_seconds
from beaconfold.operators.campaigns import apply_pairs, classify_pairs, extract_pairs, mapping_exceptions
from beaconfold.operators.files import (
    advance_feed_state,
    detect_new_files,
    encode_feed_state,
    load_manifest,
    name_state_key,
    processed_file_state,
    select_latest_files,
)
from beaconfold.operators.names import incoming_names, merge_names
from beaconfold.profiles import PartnerProfile
from beaconfold.schemas import DATED_FILE_PATTERN, NAME_TABLE
from beaconfold.sinks.tables import write_pairs
from beaconfold.sources.events import day_events
from beaconfold.sources.files import exact_paths, list_files, read_name_rows, read_pairs
from beaconfold.sources.scratch import shared_dir
from beaconfold.sources.state import SnapshotConflict, deliver, read_state, save_state, snapshot_version, update_snapshot

# The name feeds of a partner, reference table -> file name prefix.
NAME_FEEDS = {
    "PARTNER_MEASURED_ADVERTISER": "advertiser_generic_",
    "PARTNER_MEASURED_CAMPAIGN": "campaign_generic_",
    "PARTNER_MEASURED_CREATIVE": "creative_generic_",
    "PARTNER_MEASURED_PLACEMENT": "placement_generic_",
}


def extract_campaigns(
    raw: DataFrame,
    profile: PartnerProfile,
    data_date: str,
    pairs_root: str,
    tz_offset: int | None = None,
    hours: int = 24,
) -> None:
    """Write the campaign pairs met on one data day."""
    tz_offset = utc_offset_seconds(data_date) if tz_offset is None else tz_offset
    write_pairs(extract_pairs(day_events(raw, profile, data_date, tz_offset, hours)), pairs_root, data_date)


def update_campaigns(
    spark: SparkSession,
    profile: PartnerProfile,
    data_date: str,
    *,
    pairs_root: str,
    entities: DataFrame,
    campaigns_root: str,
    exceptions_path: str,
) -> bool:
    """Apply one day's extracted pairs to the campaign table; False if nothing was extracted.

    The classification feeds both the next snapshot and the exceptions report: each attempt writes down its pairs' classes
    against its own base once, and the commit carries the report along. So whatever else is written meanwhile, the report
    is that of the committed table. A run that dies after its commit has its report delivered by the next one.
    """
    deliver(spark, campaigns_root)
    pairs = read_pairs(spark, pairs_root, data_date)
    if pairs.isEmpty():
        return False
    source_id = profile.measurement_source_id

    def apply(base: DataFrame) -> tuple[DataFrame, tuple[DataFrame, str]]:
        classified = _fixed(classify_pairs(pairs, entities, base, source_id), "classified-pairs")
        return apply_pairs(base, classified, source_id), (mapping_exceptions(classified), exceptions_path)

    update_snapshot(spark, campaigns_root, apply)
    return True


def update_names(
    spark: SparkSession,
    *,
    table: str,
    source_id: int,
    files_dir: str,
    name_prefix: str,
    names_root: str,
    state_path: str,
    now: datetime,
    pattern: str = DATED_FILE_PATTERN,
    multi_line: bool = True,
) -> bool:
    """Merge the newest unprocessed name files of one feed; False if there are none.

    The selection is written down once: the same files and etags are read, merged and remembered. A file replaced
    meanwhile has another etag and is met again by the next run. State is saved last: a run that fails before is
    repeated, with the same outcome. The keys of one feed's newest date come to the driver, which has to name them to the reader.
    """
    state_key = name_state_key(table, source_id)
    listing = list_files(spark, files_dir, name_prefix).withColumn("stateKey", state_key)
    state = read_state(spark, state_path, f"name_mappings.{table}.").where(F.col("stateKey") == state_key)
    selected = _fixed(select_latest_files(listing, state, pattern), "selected-names")
    keys = [r["key"] for r in selected.select("key").toLocalIterator()]
    if not keys:
        return False

    rows = read_name_rows(spark, exact_paths(keys), multi_line=multi_line)
    incoming = incoming_names(rows, selected)
    update_snapshot(spark, names_root, lambda names: merge_names(names, incoming, source_id, now), NAME_TABLE)
    save_state(encode_feed_state(advance_feed_state(selected, state)), state_path)
    return True


def _fixed(selection: DataFrame, name: str) -> DataFrame:
    """A selection written to the shared folder, so that later listings or versions don't change it."""
    spark = selection.sparkSession
    path = shared_dir(spark, name)
    selection.write.parquet(path)
    return spark.read.schema(selection.schema).parquet(path)


def notify_new_files(
    spark: SparkSession,
    *,
    files_dir: str,
    name_prefix: str,
    files_type: str,
    state_path: str,
    client_id: str,
    notices_path: str,
    attempts: int = 5,
) -> bool:
    """Write a load notice for each new or changed file; False if there are none.

    Notices are carried by the commit of the state version that remembers their files, and are derived from the version before: of two
    runs at once one commits, and the other looks again, so each change is announced by one run. A run that dies after
    its commit has its notices delivered by the next one, to the same path: at least once.
    """
    deliver(spark, state_path)
    listing = list_files(spark, files_dir, name_prefix)
    for attempt in range(attempts):
        base = snapshot_version(spark, state_path)
        try:
            known = read_state(spark, state_path, f"{files_type}.", version=base)
            new = _fixed(detect_new_files(listing, known, files_type), "selected-files")
            if new.isEmpty():
                return False
            notices = load_manifest(new, client_id, F.col("key"))
            save_state(processed_file_state(new), state_path, (notices, notices_path), base)
            return True
        except SnapshotConflict:
            if attempt + 1 == attempts:
                raise
    raise AssertionError("unreachable")
