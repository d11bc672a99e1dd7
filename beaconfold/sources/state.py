"""Pipeline state and reference tables under numbered commits (see ``commits``).

A *reference table* is one folder per version; of two writers on the same base the second one repeats its change on the new
base. *State* is a log: a save appends a segment with its records only, and a read takes each key from the newest
segment that has it. Segments are merged when the newer ones together reach a share of the one before, so their sizes fall
geometrically: there are logarithmically many, and a record is rewritten logarithmically often. Two saves
at once both count, as segments don't depend on the base; the later number wins where they set the same key.

Old versions are removed after a commit, ``KEPT_VERSIONS`` stay for readers that began before.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.sources.commits import SnapshotConflict, deliver, latest, new_folder, next_number, outbox, prune, publish
from beaconfold.sources.scratch import remove_dir

__all__ = ["SnapshotConflict", "deliver", "read_snapshot", "read_state", "save_state", "snapshot_version", "update_snapshot", "write_snapshot"]

STATE = "stateKey string, value string"
#: Versions that stay, for readers that began before later commits.
KEPT_VERSIONS = 5
#: A segment is merged with the newer ones once it has less than so many times their records.
MERGE_RATIO = 4

#: The next version, or that and rows to hand on: (rows, where to).
Change = DataFrame | tuple[DataFrame, tuple[DataFrame, str]]


def snapshot_version(spark: SparkSession, root: str) -> int:
    """The newest committed version, 0 if there is none."""
    found = latest(spark, root)
    return found.version if found else 0


def write_snapshot(table: DataFrame, root: str, version: int, hand_on: tuple[DataFrame, str] | None = None) -> None:
    """Write and commit a version of a reference table; ``SnapshotConflict`` if that number is taken.

    ``hand_on``: rows derived from the same base, and where to deliver them once the version counts.
    """
    spark = table.sparkSession
    folder = new_folder(f"snapshot={version}")
    table.write.parquet(f"{root}/{folder}")
    content = {"folders": [folder]}
    if hand_on is not None:
        content["outbox"] = outbox(hand_on[0], root, hand_on[1])
    try:
        publish(spark, root, version, content)
    except SnapshotConflict:
        for written in (folder, *([content["outbox"]["folder"]] if hand_on else [])):
            remove_dir(spark, f"{root}/{written}")
        raise
    prune(spark, root, KEPT_VERSIONS)


def read_snapshot(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """The newest committed version. Before the first one it is an empty table, if ``schema`` is given."""
    found = latest(spark, root)
    if found:
        return spark.read.parquet(*[f"{root}/{f}" for f in found.content["folders"]])
    if schema is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.createDataFrame([], schema)


def update_snapshot(
    spark: SparkSession, root: str, change: Callable[[DataFrame], Change], schema: str | None = None, attempts: int = 5
) -> int:
    """Commit ``change`` of the newest version as the next one, again on a newer base if another writer was first.

    The base and the number are read as one: the number is taken first, so a version committed in between makes a conflict.
    Rows that ``change`` wants handed on are those of the attempt that was committed, and are delivered before return.
    """
    for attempt in range(attempts):
        version = next_number(spark, root)
        made = change(read_snapshot(spark, root, schema))
        table, hand_on = made if isinstance(made, tuple) else (made, None)
        try:
            write_snapshot(table, root, version, hand_on)
        except SnapshotConflict:
            if attempt + 1 == attempts:
                raise
            continue
        deliver(spark, root)
        return version
    raise AssertionError("unreachable")


# ---- state ------------------------------------------------------------------------------


def _newest_of(segments: list[DataFrame]) -> DataFrame:
    """Each key's record from the newest segment that has it; ``segments`` newest first.

    An older segment is only filtered by the keys of the newer ones, which are few next to it: it isn't shuffled
    as long as they can be broadcast.
    """
    parts = [segments[0]]
    for k, older in enumerate(segments[1:], 1):
        newer = reduce(DataFrame.unionByName, [s.select("stateKey") for s in segments[:k]])
        parts.append(older.join(newer, "stateKey", "left_anti"))
    return reduce(DataFrame.unionByName, parts)


def _segments(spark: SparkSession, root: str, folders: list[str]) -> list[DataFrame]:
    return [spark.read.schema(STATE).parquet(f"{root}/{f}") for f in reversed(folders)]


def read_state(spark: SparkSession, path: str, key_prefix: str = "", version: int | None = None) -> DataFrame:
    """Value per state key: (stateKey, value). Before the first save it is empty.

    Segments are sorted by key, so ``key_prefix`` leaves out the row groups of other keys. ``version`` asks for the newest
    commit to be this one (0: none), ``SnapshotConflict`` if it isn't.
    """
    found = latest(spark, path)
    if version is not None and version != (found.version if found else 0):
        raise SnapshotConflict(f"version {version} of {path} is not the newest one")
    if found is None:
        return spark.createDataFrame([], STATE)
    segments = _segments(spark, path, found.content["folders"])
    if key_prefix:
        segments = [s.where(F.col("stateKey").startswith(key_prefix)) for s in segments]
    return _newest_of(segments)


def _write_segment(records: DataFrame, path: str) -> tuple[str, int]:
    spark, folder = records.sparkSession, new_folder("segment")
    records.select("stateKey", "value").hint("rebalance", "stateKey").sortWithinPartitions("stateKey").write.parquet(f"{path}/{folder}")
    # Row counts of Parquet files come from their footers.
    return folder, spark.read.schema(STATE).parquet(f"{path}/{folder}").count()


def save_state(records: DataFrame, path: str, hand_on: tuple[DataFrame, str] | None = None, base: int | None = None, attempts: int = 5) -> int:
    """Set state records (one per key); others stay. Returns the version.

    With ``base``, records and what is handed on were derived from that version, and another one since is a
    ``SnapshotConflict``. Without, records just override, whatever was saved meanwhile.
    """
    spark = records.sparkSession
    folder, rows = _write_segment(records, path)
    box = None if hand_on is None else outbox(hand_on[0], path, hand_on[1])
    for attempt in range(attempts):
        version, found = next_number(spark, path), latest(spark, path)
        held = found.content if found else {"folders": [], "rows": []}
        content = {"folders": [*held["folders"], folder], "rows": [*_counts(spark, path, held), rows]}
        if box:
            content["outbox"] = box
        try:
            if base is not None and base != (found.version if found else 0):
                raise SnapshotConflict(f"version {base} of {path} is not the newest one")
            publish(spark, path, version, content)
            break
        except SnapshotConflict:
            if base is not None or attempt + 1 == attempts:
                for written in (folder, *([box["folder"]] if box else [])):
                    remove_dir(spark, f"{path}/{written}")
                raise
    _merge_segments(spark, path)
    deliver(spark, path)
    prune(spark, path, KEPT_VERSIONS)
    return version


def _counts(spark: SparkSession, path: str, content: dict) -> list[int]:
    """Records per segment; a commit of an earlier release doesn't say."""
    return content.get("rows") or [f.count() for f in reversed(_segments(spark, path, content["folders"]))]


def merge_from(rows: list[int], ratio: int = MERGE_RATIO) -> int:
    """The first of the segments, oldest first, that are due to be merged with all after it; the last if none is."""
    after = 0
    due = len(rows) - 1
    for k in reversed(range(len(rows))):
        if after and rows[k] < ratio * after:
            due = k
        after += rows[k]
    return due


def _merge_segments(spark: SparkSession, path: str) -> None:
    """Merge the newest segments if they are due. A save in between leaves it to the next one."""
    version, found = next_number(spark, path), latest(spark, path)
    folders, rows = found.content["folders"], found.content["rows"]
    first = merge_from(rows)
    if first >= len(folders) - 1:
        return
    folder, merged = _write_segment(_newest_of(_segments(spark, path, folders[first:])), path)
    content = {"folders": [*folders[:first], folder], "rows": [*rows[:first], merged]}
    try:
        publish(spark, path, version, content)
    except SnapshotConflict:
        remove_dir(spark, f"{path}/{folder}")
