"""Data days that are replaced as a whole or not at all.

A date's folder ``date=…`` holds versions of the day (``_versions/v-…``) and numbered commits that say which one counts. A
rewrite is staged as a new version and then committed: until that moment readers get the old day, a rewrite that fails
leaves it readable, and a rerun leaves nothing of the earlier run in the day nor touches other dates. Readers ask
``day_folder`` once and read that version, which stays for ``KEPT_DAYS`` rewrites. Days written by the first release, without
commits, are read from the folder itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from beaconfold.functions.expressions import nodash
from beaconfold.sources.commits import SnapshotConflict, latest, new_folder, next_number, prune, publish

#: Versions of a day that stay, for readers that began before a rewrite.
KEPT_DAYS = 2


def date_path(root: str, data_date: str) -> str:
    return f"{root.rstrip('/')}/date={nodash(data_date)}"


def day_folder(spark: SparkSession, root: str, data_date: str) -> str:
    """Where the committed version of a day is."""
    day = date_path(root, data_date)
    found = latest(spark, day)
    return f"{day}/{found.content['folders'][0]}" if found else day


def replace_day(spark: SparkSession, root: str, data_date: str, write: Callable[[str], None], attempts: int = 20) -> str:
    """Have a new version of a day written and make it the one that counts; of two rewrites at once the later commit does."""
    day, folder = date_path(root, data_date), new_folder("_versions/v")
    write(f"{day}/{folder}")
    for attempt in range(attempts):
        try:
            publish(spark, day, next_number(spark, day), {"folders": [folder]})
            break
        except SnapshotConflict:
            if attempt + 1 == attempts:
                raise
    prune(spark, day, KEPT_DAYS)
    return f"{day}/{folder}"
