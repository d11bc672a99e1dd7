"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is cut into blocks of equal token numbers. Blocks are seats: sources get them by highest quotients of their
targets, then each source's shards get theirs by highest quotients of their sizes. A shard's documents stand in an order
drawn from the seed, cut into equal blocks; its quota is all blocks as often as it holds their number, and for the rest
consecutive blocks, round the end, from a start drawn from the seed. So what a document gives is the overlap of two
ranges: no block is ever a row, and blocks can be as small as wanted.

A source with a third of all words is split into more shards. Only one row a source comes to the driver: its name and
size; more than ``max_sources`` are refused. Sources with equal quotients get their seat in order of name.

Defined results: null text has size 0 and gives nothing; the null source is a source, last in order; equal rows are
separate rows with a share of their own; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from beaconfold.llm.common import apply_copies, plain_text, row_key, staged, table

SEED = 20240229
SHARD_WORDS = 1 << 20
MAX_SHARDS = 4096
MAX_BLOCK = 1024


def sainte_lague(weights: Sequence[float], seats: int) -> np.ndarray:
    """Seats by highest quotients weight / 1, 3, 5, ...; ties go to the first."""
    w = np.asarray(weights, float)
    if seats <= 0 or w.sum() <= 0:
        return np.zeros(len(w), np.int64)
    # Rounding by one divisor is an apportionment of its own total; single steps lead from there to the wanted one.
    q = np.floor(w * (seats / w.sum()) + 0.5).astype(np.int64)
    missing = seats - int(q.sum())
    if missing > 0:
        heap = [(-x / (2 * k + 1), i) for i, (x, k) in enumerate(zip(w, q, strict=True))]
        heapq.heapify(heap)
        for _ in range(missing):
            _, i = heap[0]
            q[i] += 1
            heapq.heapreplace(heap, (-w[i] / (2 * q[i] + 1), i))
    elif missing < 0:
        heap = [(x / (2 * k - 1), -i) for i, (x, k) in enumerate(zip(w, q, strict=True)) if k > 0]
        heapq.heapify(heap)
        for _ in range(-missing):
            _, i = heapq.heappop(heap)
            q[-i] -= 1
            if q[-i] > 0:
                heapq.heappush(heap, (w[-i] / (2 * q[-i] - 1), i))
    return q


def capped_targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> np.ndarray:
    """``share`` of all sizes dealt out by weight; nobody gets over ``most`` times its size, the excess is dealt again."""
    caps = np.asarray(sizes, float) * most
    w = np.asarray(weights, float)
    total = share * float(np.sum(sizes))
    full = np.zeros(len(caps), bool)
    while True:
        open_weight = w[~full].sum()
        targets = np.where(full, caps, (total - caps[full].sum()) * w / open_weight if open_weight > 0 else caps)
        above = ~full & (targets > caps)
        if not above.any():
            return targets
        full |= above


def mix(
    docs: DataFrame, weigh: Callable[[int], float] = lambda i: (3, 1, 2)[i % 3], share: float = 1.5, most: int = 2,
    seed: int = SEED, shard_words: int = SHARD_WORDS, max_sources: int = 1_000_000,
) -> DataFrame:
    """(doc_id, row, source, size, source_size, target, taken) for each row of ``docs`` (doc_id, text, source).

    ``weigh`` gives the weight of the source at a place in the order of code points.
    """
    spark = docs.sparkSession
    size = F.regexp_count(plain_text(), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    sized, _ = staged(docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "source", size.alias("size")), "sizes")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("words")).orderBy(F.col("source").asc_nulls_last())
    sources = by_source.limit(max_sources + 1).collect()
    if len(sources) > max_sources:
        raise ValueError(f"over {max_sources} sources: give a coarser source column")
    words = np.array([r.words for r in sources], np.int64)
    targets = capped_targets(words, [weigh(i) for i in range(len(words))], share, most)
    block = int(np.clip(words[words > 0].min() // 256 if (words > 0).any() else 1, 1, MAX_BLOCK))
    seats = sainte_lague(targets, round(float(targets.sum()) / block))
    shards = np.clip(-(-words // shard_words), 1, MAX_SHARDS)
    plan = [(r.source, int(w), float(t), int(s), int(n)) for r, w, t, s, n in zip(sources, words, targets, seats, shards, strict=True)]
    plan = spark.createDataFrame(plan, "source string, source_size bigint, target double, seats bigint, shards bigint")
    named = plan.withColumnRenamed("source", "_source")
    sharded = (
        sized.join(named, sized["source"].eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "row"), F.col("shards")))
    )

    def quotas(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("shard")
        blocks = np.maximum(1, -(-group["words"] // block))
        quota = np.minimum(sainte_lague(group["words"], int(group["seats"].iloc[0])), most * blocks)
        return group.assign(blocks=blocks, quota=quota)[["source", "shard", "words", "blocks", "quota"]]

    by_shard = sharded.groupBy("source", "shard", "seats").agg(F.sum("size").alias("words"))
    quota = by_shard.groupBy("source").applyInPandas(quotas, "source string, shard bigint, words bigint, blocks bigint, quota bigint")
    quota, _ = staged(quota, "quotas")
    quota = quota.withColumnsRenamed({"source": "_source", "shard": "_shard"})
    order = W.Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "row"), "row", "doc_id").rowsBetween(W.Window.unboundedPreceding, 0)
    placed = sharded.withColumn("end", F.sum("size").over(order)).join(
        quota, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard"))
    )
    start = F.pmod(F.xxhash64(F.lit(seed + 2), F.coalesce("source", F.lit("")), "shard"), F.col("blocks"))
    rest = F.col("quota") % F.col("blocks")

    def at(i):
        return F.floor(i * F.col("words") / F.col("blocks")).cast(T.LongType())

    def overlap(lo, hi):
        return F.greatest(F.lit(0), F.least(F.col("end"), hi) - F.greatest(F.col("end") - F.col("size"), lo))

    placed = placed.withColumns({"_from": start, "_to": start + rest})
    run = overlap(at(F.col("_from")), at(F.least("_to", "blocks"))) + overlap(F.lit(0), at(F.greatest(F.col("_to") - F.col("blocks"), F.lit(0))))
    taken = F.floor(F.col("quota") / F.col("blocks")).cast("bigint") * F.col("size") + run
    return placed.select("doc_id", "row", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents as often as the mix takes them, to the nearest whole number; those without words go."""
    whole = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)) + 0.5)
    mixed = mix(docs).groupBy("doc_id", "row").agg(F.sum(whole).alias("copies"), F.count("*").alias("times"))
    return apply_copies(docs, mixed)
