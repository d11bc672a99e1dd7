"""Token ids in a compact file format: canonical Huffman code, length-limited, decodable in independent blocks.

Ids are counted over the whole corpus; package-merge gives code lengths of at most ``limit`` bits, and lengths alone
define the canonical code. Documents are written in order of id as segments: whole documents of about ``SEGMENT_IDS``
ids together, their code as one run of bits, and a checkpoint, the bit offset, every ``BLOCK_IDS`` ids. A block between
checkpoints can be decoded without the others; the reader decodes all blocks of a segment in step, by one table lookup an id.

Files are Parquet: ``segments`` with a row for each segment, ``code`` with (id, length). A task holds one segment: about
``SEGMENT_IDS`` ids or one longer document. Only the vocabulary's counts and one total per partition come to the driver.

Defined results: null text is empty and has the end id alone; order is by doc_id (null first), then by a key of the
text; equal rows are written each; an empty table gives empty files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from beaconfold.llm.common import discard, row_key, staged, table
from beaconfold.llm.tokens import encoder
from beaconfold.sources.scratch import shared_dir

BLOCK_IDS = 64
SEGMENT_IDS = 1 << 18
PART_IDS = 16 << 20
LIMIT = 18
SEGMENT = "part int, segment int, first bigint, n bigint, docs array<bigint>, sizes array<bigint>, bits bigint, checkpoints binary, payload binary"


def limited_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge; 0 for what doesn't occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    packages = np.zeros(0, np.int64)
    is_leaf = []
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        merged = merged[order]
        is_leaf.append(order < n)
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    take = 2 * n - 2
    own = np.zeros(n, np.uint8)
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        own[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[used] = own
    return lengths


@dataclass
class Code:
    """A canonical code: by length, then by id."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        ids = np.flatnonzero(self.lengths)
        ids = ids[np.lexsort((ids, self.lengths[ids]))]
        self.width = int(self.lengths.max()) if len(ids) else 1
        # Codes left-aligned to the greatest length follow one another without gaps.
        steps = np.int64(1) << (self.width - self.lengths[ids].astype(np.int64))
        aligned = np.cumsum(steps) - steps
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[ids] = (aligned >> (self.width - self.lengths[ids].astype(np.int64))).astype(np.uint64)
        self.ids = np.zeros(1 << self.width, np.uint32)
        self.ids[: int(steps.sum())] = np.repeat(ids, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, int, np.ndarray]:
        """The code's bytes, its bits, and the bit offset of every ``BLOCK_IDS``-th id."""
        lengths = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        bits = int(ends[-1]) if len(ids) else 0
        words = bits // 32 + 2
        shifted = self.codes[ids] << (64 - (starts & 31) - lengths).astype(np.uint64)
        # No two codes share a bit, so sums are unions; each is below 2**32 and exact in a double.
        out = np.bincount(starts >> 5, (shifted >> np.uint64(32)).astype(np.float64), words)
        out += np.bincount((starts >> 5) + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
        return out.astype(">u4").tobytes()[: -(-bits // 8)], bits, starts[::BLOCK_IDS].astype("<u8")

    def decode(self, payload: bytes, n: int, checkpoints: np.ndarray) -> np.ndarray:
        padded = payload + bytes(-len(payload) % 4 + 8 + 4 * self.width * BLOCK_IDS // 32)
        words = np.frombuffer(padded, ">u4").astype(np.uint64)
        pairs = words[:-1] << np.uint64(32) | words[1:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((BLOCK_IDS, len(at)), np.uint32)
        mask = np.uint64((1 << self.width) - 1)
        for k in range(BLOCK_IDS):
            window = pairs[np.minimum(at >> 5, len(pairs) - 1)] >> (64 - self.width - (at & 31)).astype(np.uint64) & mask
            out[k] = self.ids[window]
            at += self.lengths[out[k]]
        return out.T.ravel()[:n]


def _tokens(path: str, end_id: int):
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            ids, counts = code.encode(batch.column("text"))
            ends = np.cumsum(counts)
            size = max(ids.dtype.itemsize, 2 if end_id < 1 << 16 else 4)
            ids = np.insert(ids.astype(f"<u{size}"), ends, end_id)
            bounds = (np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * size).astype(np.int64)
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(np.full(len(counts), size, np.int32)), data], ["doc_id", "row", "size", "ids"])

    return tokens


def _values(ids: pa.Scalar, size: int) -> np.ndarray:
    return np.frombuffer(ids.as_buffer(), f"<u{size}")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for size, ids in zip(batch.column("size").to_pylist(), batch.column("ids"), strict=True):
            values = _values(ids, size)
            top = int(values.max()) + 1
            if top > len(counts):
                counts = np.concatenate([counts, np.zeros(max(top, 1 << 16) - len(counts), np.int64)])
            if len(values) > 4096:
                counts += np.bincount(values, minlength=len(counts))
            else:
                np.add.at(counts, values, 1)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(counts[used])], ["id", "n"])


def _write(code):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        n = first = segment = 0
        part = 0

        def segment_row():
            ids = np.concatenate([v for _, v in held])
            payload, bits, checkpoints = code.value.encode(ids)
            row = {"part": part, "segment": segment, "first": first, "n": len(ids), "docs": [d for d, _ in held], "sizes": [len(v) for _, v in held], "bits": bits, "checkpoints": checkpoints.tobytes(), "payload": payload}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("bits", pa.int64()), ("checkpoints", pa.binary()), ("payload", pa.binary())]))

        for batch in batches:
            for part, doc, size, ids in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("size").to_pylist(), batch.column("ids"), strict=True):
                values = _values(ids, size).astype(np.uint32)
                if held and n + len(values) > SEGMENT_IDS:
                    yield segment_row()
                    first, segment, n = first + n, segment + 1, 0
                    held.clear()
                held.append((doc, values))
                n += len(values)
        if held:
            yield segment_row()

    return write


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 2, limit: int = LIMIT) -> None:
    """Tokenises ``docs`` (doc_id, text) and writes ``path``/segments and ``path``/code."""
    spark = docs.sparkSession
    read = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    tokens = read.mapInArrow(_tokens(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), end_id), "doc_id bigint, row bigint, size int, ids binary")
    tokens, tokens_at = staged(tokens, "tokens")
    counted = tokens.select("size", "ids").mapInArrow(_count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"]] = counted["n"]
    code = Code(limited_lengths(counts, limit))
    lengths = [(int(i), int(code.lengths[i])) for i in np.flatnonzero(code.lengths)]
    spark.createDataFrame(lengths, "id int, length int").coalesce(1).write.parquet(f"{path}/code")
    parts = max(1, -(-int(counts.sum()) // PART_IDS), min(32, int(counts.sum()) // (1 << 20)))
    ordered = tokens.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "row").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row")
    shared = spark.sparkContext.broadcast(code)
    ordered.select(F.spark_partition_id().alias("part"), "doc_id", "size", "ids").mapInArrow(_write(shared), SEGMENT).write.parquet(f"{path}/segments")
    discard(spark, tokens_at)


DECODED = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def _read(code, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in DECODED.split(", ")]
        types = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            for row in batch.to_pylist():
                ids = code.value.decode(row["payload"], row["n"], np.frombuffer(row["checkpoints"], "<u8")).astype("<u4")
                at, out = 0, []
                for doc, size in zip(row["docs"], row["sizes"], strict=True):
                    data = ids[at : at + size].tobytes()
                    out.append((doc, row["base"] + row["first"] + at, size, zlib.crc32(data), data if with_ids else None))
                    at += size
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return read


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Rows of DECODED from files that ``write_ids`` wrote."""
    segments = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    known = spark.read.schema("id int, length int").parquet(f"{path}/code").toPandas()
    lengths = np.zeros(int(known["id"].max()) + 1 if len(known) else 1, np.uint8)
    lengths[known["id"]] = known["length"]
    code = spark.sparkContext.broadcast(Code(lengths))
    # One row for each part of some 16 million ids: its ids and those of all parts before it.
    totals = segments.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1))
    # Written, so that the join knows its size: a small one is broadcast, and segments aren't shuffled for it.
    bases, _ = staged(totals.select("part", F.coalesce(before, F.lit(0)).alias("base")), "bases")
    return segments.join(bases, "part").mapInArrow(_read(code, with_ids), DECODED)


def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path, with_ids=False).drop("ids")
