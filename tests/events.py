"""Random raw events with NULLs, copies and late events."""

import random

from pyspark.sql import types as T

from beaconfold.schemas import EVENT_TYPES, FRAUD_CATEGORIES, RAW_EVENTS, WIRE_NAMES

RAW_WITH_ORDER = T.StructType([*RAW_EVENTS.fields, T.StructField("event_seq", T.LongType())])


def random_events(n, sessions, seed=7):
    rng = random.Random(seed)

    def maybe(*values):
        return rng.choice([None, *values])

    rows = []
    for seq in rng.sample(range(n * 10), n):
        hour = rng.randrange(5, 24)
        rows.append(
            {
                "impressionid": rng.choice([None, *(f"i{k}" for k in range(sessions))]),
                "type": maybe("impression", "impression", "pause", *EVENT_TYPES.values()),
                "timestamp": rng.randrange(3),
                "site": maybe("a", "b"),
                "sourceid": maybe(1, 2),
                "advertiserid": maybe(1, 2),
                "campaignid": maybe(1, 2),
                "placementid": maybe(1, 2),
                "creativeid": maybe(1, 2),
                "mediatypeid": maybe(1, 2),
                "endpoint": maybe("display", "video", "display", "video", "other"),
                "measurable": maybe(0, 1, 2, 3),
                "inview50": maybe(True, False),
                "inview100": maybe(True, False),
                "noncontinuousplaytime": maybe(500, 1500, 3000),
                "audibleplaytime": maybe(0, 499, 500, 2000),
                "fullscreen": maybe(True, False),
                "suspicious": maybe(True, False, False),
                "givt": maybe(True, False, False),
                "fraudcategory": maybe(*FRAUD_CATEGORIES),
                "iasadventityid": maybe(0, 1, 2),
                "utcdate": "20240115",
                "utchour": f"{hour:02d}",
                "event_seq": seq,
            }
        )
    return rows


def frame(spark, rows, partitions=8):
    data = [tuple(r[c] for c in RAW_WITH_ORDER.names) for r in rows]
    return spark.createDataFrame(data, RAW_WITH_ORDER).repartition(partitions)


def canonical(rows):
    return [{WIRE_NAMES.get(k, k): v for k, v in r.items()} for r in rows]
