"""Event deduplication and detection of oversized sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconfold.sources.events import ORDER

# Keys are counted in this many hash buckets; one is hot at this multiple of the mean bucket.
HASH_BUCKETS = 65_536
HOT_FACTOR = 4

# A hot session's events are dealt over this many groups before they are collapsed.
SALTS = 1024


def dedupe_events(events: DataFrame, keys: Sequence[str], order: str = ORDER) -> DataFrame:
    """One event per key: the first by ``order``, or where there is no such column the least by all columns in order of name.

    Written as ``min`` over a struct rather than as a window, because copies then collapse
    in the map tasks: a key with very many copies sends one row per task, not all of them.
    """
    payload = sorted(c for c in events.columns if c not in (*keys, order))
    first = [order, *payload] if order in events.columns else payload
    if not first:
        return events.select(*keys).distinct()
    return (
        events.groupBy(*keys)
        .agg(F.min(F.struct(*first)).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in events.columns])
    )


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS)).alias("_bucket")


def hot_buckets(events: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Hash buckets of ``keys`` that hold far more rows than their share.

    A key with a large part of all rows makes its bucket stand out, so reading the key
    columns once and counting per bucket finds it. A map task sends at most ``HASH_BUCKETS``
    counts. Counts add up to all rows, so at most ``HASH_BUCKETS / HOT_FACTOR`` buckets can be
    hot: that bounds the result. A key outside hot buckets
    has under ``min_rows`` rows or under ``HOT_FACTOR / HASH_BUCKETS`` of all.
    """
    counts = events.groupBy(_bucket(keys)).agg(F.count("*").alias("_rows"))
    # One row per bucket, so this window is small however large the data.
    total = F.sum("_rows").over(Window.partitionBy(F.lit(0)))
    return (
        counts.withColumn("_share", total * HOT_FACTOR / HASH_BUCKETS)
        .where((F.col("_rows") >= min_rows) & (F.col("_rows") >= F.col("_share")))
        .select("_bucket")
    )


def with_salt(events: DataFrame, hot: Sequence[int], keys: Sequence[str], salt: str = "_salt") -> DataFrame:
    """Events with a salt: 0 outside the given hot buckets, and 1 to ``SALTS`` in turn inside.

    It goes by a row's place in its input split, which a repeated read of a file finds again; equal rows get different salts.
    """
    inside = f"pmod(xxhash64({', '.join(keys)}), {HASH_BUCKETS}) IN ({', '.join(map(str, hot))})" if hot else "false"
    return events.selectExpr("*", f"CASE WHEN {inside} THEN pmod(monotonically_increasing_id(), {SALTS}) + 1 ELSE 0 END AS {salt}")
