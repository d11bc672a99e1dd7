"""Session plans compared, without and with one session holding a third of all events.

``python bench_skew.py [replicas]`` enlarges the test events (``BENCH_SF_DIR``) that many times under a
new folder and prints seconds per plan. All plans but the last, which keeps any copy, yield the same sessions.
"""

from __future__ import annotations

import os
import sys
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold import fixtures as fx
from beaconfold.operators.events import dedupe_events, hot_buckets
from beaconfold.operators.sessions import ad_sessions, fold_events, session_columns
from beaconfold.profiles import SNAPCHAT
from beaconfold.sources.events import day_events, read_events
from beaconfold.sources.scratch import shared_dir

DATE, OFFSET = "2024-01-15", -18000
PROFILE = replace(SNAPCHAT, event_order="event_seq")


def enlarged(events: DataFrame, replicas: int, skewed: bool) -> DataFrame:
    """Every event under ``replicas`` impressions; with skew half as many again under a single one."""
    copies = events.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(replicas))))
    out = copies.withColumn("impressionid", F.concat_ws("-", "impressionid", "n"))
    if skewed:
        # Half of the large session are copies of few events, the rest spreads over many times.
        is_copy = F.col("n") % 2 == 0
        large = copies.where(F.col("n") <= replicas // 2).withColumns(
            {
                "impressionid": F.lit("large"),
                "timestamp": F.when(is_copy, 1).otherwise(F.pmod(F.xxhash64("event_seq", "timestamp", "n"), F.lit(10**7))),
                "type": F.when(is_copy, F.lit("impression")).otherwise(F.col("type")),
            }
        )
        out = out.unionByName(large)
    return out.drop("n").withColumns({"utcdate": F.lit("20240115"), "utchour": F.lit("12")})


def main() -> None:
    replicas = int(sys.argv[1]) if len(sys.argv) > 1 else 16
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    keys, dedupe_keys = list(PROFILE.session_keys), list(PROFILE.dedupe_keys)
    root = shared_dir(spark, "skew")
    for skewed in (False, True):
        path = f"{root}/{skewed}"
        data = enlarged(fx.raw_events(spark, sf_dir), replicas, skewed)
        data.repartition(16).write.partitionBy("utcdate", "utchour").parquet(path)
        events = day_events(read_events(spark, PROFILE, path=path), PROFILE, DATE, OFFSET)

        def folded(deduped: DataFrame) -> DataFrame:
            return session_columns(fold_events(deduped, PROFILE), DATE, OFFSET)

        plans = {
            "detect": lambda: hot_buckets(events, keys, 1_000_000),
            "as built": lambda: ad_sessions(events, PROFILE, DATE, OFFSET),
            "one shuffle, no split": lambda: folded(dedupe_events(events.repartition(*keys), dedupe_keys)),
            "two shuffles": lambda: folded(dedupe_events(events, dedupe_keys)),
            "dropDuplicates, two shuffles": lambda: folded(events.dropDuplicates(dedupe_keys)),
        }
        print(f"skewed={skewed} events={events.count()}", flush=True)
        for name, plan in plans.items():
            times = []
            for _ in range(2):
                start = time.perf_counter()
                plan().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            print(f"  {name}: {min(times):.1f} s", flush=True)


if __name__ == "__main__":
    main()
