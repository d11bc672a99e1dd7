"""Exact dedup by Golomb-coded fingerprint exchange.

Each document gets a 64-bit fingerprint of its normalised text. Every sending partition sorts its fingerprints by owner
(ranges of the fingerprint space) and sends each owner one compressed block: sorted differences, Golomb-Rice coded. The
owner answers each sender with a bitmap of those that occur more than once anywhere. Only documents with their bit
set, the suspects, have their texts shuffled; grouping by the text itself is the byte verification, and partial
aggregation leaves one row per text and map task, so a group of any size is no burden to one task.

Equal means: the same after deleting ``[\\x20\\x09-\\x0D]``. The row with most code points in its original text, then the
smallest doc_id stays. Null text is empty and null doc_ids come last; rows equal in id and text form a group like any
others, of which one row stays. Extra columns stay in ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.llm.common import SPACE, carried, plain_text, staged, table

#: Fingerprints an owner is meant to get; with the count of documents this gives the number of owners.
OWNED = 2_000_000
BLOCK = "owner int, n bigint, code binary, again binary"


def golomb_encode(values: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit values as Rice-coded differences, the first one as it is."""
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values)
    k = int(max(0, np.floor(np.log2(max(1.0, float(gaps.mean()) * 0.69))))) if n > 1 else 0
    high = gaps >> np.uint64(k)
    # Unary part: for each gap, `high` zeros and a one, so ones stand at cumsum(high) + index.
    ones = np.cumsum(high.astype(np.int64) + 1) - 1 if n > 1 else np.zeros(0, np.int64)
    unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, np.uint8)
    unary[ones] = 1
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if k else np.zeros(0, np.uint8)
    unary_bytes = np.packbits(unary).tobytes()
    head = np.array([values[0], k, len(unary_bytes)], np.uint64).tobytes()
    return head + unary_bytes + np.packbits(low.ravel()).tobytes()


def golomb_decode(code: bytes, n: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, np.uint64)
    first, k, size = np.frombuffer(code, np.uint64, 3)
    k, size = int(k), int(size)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(code, np.uint8, size, 24)))[: n - 1]
    gaps = (np.diff(ones, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=24 + size))[: (n - 1) * k].reshape(n - 1, k)
        gaps |= (bits.astype(np.uint64) << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(np.concatenate([[first], gaps]), dtype=np.uint64)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE + "+", "")


def _owner(fingerprints: np.ndarray, owners: int) -> np.ndarray:
    return ((fingerprints >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def _blocks(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, times = np.unique(batch.column("print").to_numpy().view(np.uint64), return_counts=True)
            cuts = np.searchsorted(_owner(own, owners), np.arange(owners + 1))
            parts = [(o, a, b) for o, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o for o, _, _ in parts], pa.int32()),
                    pa.array([int(b - a) for _, a, b in parts], pa.int64()),
                    pa.array([golomb_encode(own[a:b]) for _, a, b in parts], pa.binary()),
                    pa.array([np.packbits(times[a:b] > 1).tobytes() for _, a, b in parts], pa.binary()),
                ],
                ["owner", "n", "code", "again"],
            )

    return send


def _answer(blocks: pa.Table) -> pa.Table:
    """The owner's bitmaps for all its senders' blocks."""
    sizes, again = blocks["n"].to_pylist(), blocks["again"].to_pylist()
    lists = [golomb_decode(c, n) for c, n in zip(blocks["code"].to_pylist(), sizes, strict=True)]
    once, times = np.unique(np.concatenate(lists), return_counts=True)
    twice = once[times > 1]
    maps = []
    for values, bits, n in zip(lists, again, sizes, strict=True):
        own = np.unpackbits(np.frombuffer(bits, np.uint8))[:n].astype(bool)
        maps.append(np.packbits(own | np.isin(values, twice, assume_unique=True)).tobytes())
    return pa.table({"n": blocks["n"], "code": blocks["code"], "bitmap": pa.array(maps, pa.binary())})


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What senders make of the answers: the fingerprints whose bit is set."""
    for batch in batches:
        for n, code, bits in zip(*(batch.column(c).to_pylist() for c in ("n", "code", "bitmap")), strict=True):
            found = golomb_decode(code, n)[np.unpackbits(np.frombuffer(bits, np.uint8))[:n].astype(bool)]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["print"])


def suspects(prints: DataFrame, n_rows: int) -> DataFrame:
    """The distinct fingerprints of ``prints`` (print) that occur twice or more.

    ``n_rows`` sets the number of owners. A sender is one Arrow batch of a task; what it holds twice itself travels once,
    with a bit, so an owner gets a fingerprint at most once from each block.
    """
    owners = max(1, -(-n_rows // OWNED), min(64, n_rows // 20_000))
    sent = prints.select("print").mapInArrow(_blocks(owners), BLOCK)
    answered = sent.groupBy("owner").applyInArrow(_answer, "n bigint, code binary, bitmap binary")
    return answered.mapInArrow(_suspects, "print bigint").distinct()


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, digest, chars, print, keep_id, keep_chars, group_size): one for each document."""
    spark = docs.sparkSession
    bare = normalised(plain_text())
    digests, _ = staged(
        docs.select("doc_id", F.unhex(F.sha2(bare, 256)).alias("digest"), F.length(plain_text()).cast("bigint").alias("chars")).withColumn("print", F.xxhash64("digest")),
        "digests",
    )
    doubted, _ = staged(suspects(digests, digests.count()), "suspects")
    # Texts of suspects only; the text is the key, so equality is by bytes.
    texts = docs.select("doc_id", F.length(plain_text()).cast("bigint").alias("chars"), bare.alias("bare"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("bare", 256))).withColumn("print", F.xxhash64("digest"))
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), F.col("doc_id")))
    groups = (
        texts.join(doubted, "print", "left_semi").groupBy("digest", "bare").agg(best.alias("best"), F.count("*").alias("group_size")).where("group_size > 1")
        .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.chars")).alias("keep_chars"), "group_size")
    )
    groups, _ = staged(groups, "groups")
    return digests.join(groups, "digest", "left").withColumns(
        {
            "grouped": F.col("group_size").isNotNull(),
            "keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")),
            "keep_chars": F.coalesce("keep_chars", "chars"),
            "group_size": F.coalesce("group_size", F.lit(1)).cast("bigint"),
        }
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns; of rows equal in id and length within a group, one."""
    found = duplicate_groups(docs).where("grouped").select("digest", "keep_id", "keep_chars").distinct()
    keyed = docs.select(
        carried(docs).alias("doc"), F.col("doc_id").alias("id"), F.unhex(F.sha2(normalised(plain_text()), 256)).alias("key"), F.length(plain_text()).cast("bigint").alias("chars")
    )
    joined = keyed.join(found, F.col("key") == F.col("digest"), "left")
    alone = joined.where("digest IS NULL").select("doc.*")
    winners = joined.where("digest IS NOT NULL AND id <=> keep_id AND chars = keep_chars")
    # Rows of the same id and text may be repeated: one of them stays.
    first = winners.groupBy("key").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc")).select("doc.*")
    return alone.unionByName(first)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = duplicate_groups(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return groups.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal documents, one stays."""
    return drop_copies(docs)


OP8_SQL = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
    FROM documents
), k AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k
"""
