"""Daily rollup of ad sessions to counts per dimension tuple."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.functions.expressions import flag_count
from beaconfold.schemas import MART_KEYS, MART_MEASURES, SESSION_DATA, mart_column


def daily_mart(sessions: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Counts per dimension tuple; NULL dimensions form groups of their own.

    Every aggregate is a sum or a count, so a map task sends one row per tuple it met,
    however many sessions share the tuple. ``extra_keys=("site",)`` gives the per-site grain.
    """
    flags = [f.name for f in SESSION_DATA.fields if isinstance(f.dataType, T.BooleanType)]
    counted = (
        sessions.withColumn("hit_date", F.to_date("date", "yyyyMMdd"))
        .groupBy(*extra_keys, *MART_KEYS)
        .agg(
            F.count("hit_date").alias("imps"),
            *[F.expr(f"{flag_count(flag)} AS {mart_column(flag)}") for flag in flags],
        )
    )
    measures = [
        f.name if f.name in counted.columns else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
        for f in MART_MEASURES.fields
    ]
    return counted.selectExpr(*extra_keys, *MART_KEYS, *measures)
