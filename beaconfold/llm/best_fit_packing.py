"""Best-fit packing by exact-complement hashing.

Only the number of pieces of each length matters to the plan, and there are at most ``capacity`` lengths: the histogram
comes to the driver, the plan is made on counts, and the pieces get their places in Spark by their rank among
those of their length. From the longest length down, what fills its gap exactly is looked up: one piece, a pair or a
triple of lengths by their sum; as many such sequences are made at once as the counts allow. The rest is packed best-fit,
longest first, again in bulk. Ranks are dealt by counts of (length, bucket), so a length that a third of all
pieces have is no burden to one task.

Defined results: null text is empty and leaves the end id; rows equal in id and text are packed each; an empty table
gives an empty one.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from beaconfold.llm.common import row_key, staged, table
from beaconfold.llm.tokens import encoder

CAPACITY = 4096
#: Pieces of one length that are ranked together, and buckets a length has at most.
BUCKET_PIECES, MAX_BUCKETS = 256, 65_536
PIECES = "doc_id bigint, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def _cut(path: str, end_id: int, capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            ids, counts = code.encode(batch.column("text"))
            bounds = np.concatenate([[0], np.cumsum(counts)])
            rows = []
            for doc, row, a, b in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                own = np.append(ids[a:b], end_id).astype("<u4")
                for k, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity].tobytes()
                    rows.append((doc, row, k, start, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            names = [field.split()[0] for field in PIECES.split(", ")]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return cut


def cut_pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids; ``ids`` is null unless asked for."""
    read = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    return read.mapInArrow(_cut(path, end_id, capacity, with_ids), PIECES)


class Complements:
    """Index of which available lengths sum exactly to a gap: one, a pair by its sum, or one and an indexed pair.

    A sum's pairs are listed when it is first asked for. As counts only fall, a pair with a length that is used up leaves the list for good; one
    that is only short of what is held back for the moment stays in it.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.pairs: dict[int, list[int]] = {}
        self.no_triple: set[int] = set()
        self.passed_over = False

    def _enough(self, parts: tuple[int, ...]) -> bool:
        return all(self.counts[x] >= parts.count(x) for x in parts)

    def _of_sum(self, total: int) -> list[int]:
        """The shorter lengths of a sum's pairs, the shortest last."""
        if total not in self.pairs:
            low = np.arange(1, total // 2 + 1)
            self.pairs[total] = low[(self.counts[low] > 0) & (self.counts[total - low] > 0)][::-1].tolist()
        return self.pairs[total]

    def pair(self, total: int, held: tuple[int, ...]) -> tuple[int, int] | None:
        found = self._of_sum(total) if total > 1 else []
        at = len(found) - 1
        while at >= 0:
            low = found[at]
            if not (self.counts[low] and self.counts[total - low]):
                del found[at]
            elif self._enough((*held, total - low, low)):
                return total - low, low
            else:
                self.passed_over = True
            at -= 1
        return None

    def triple(self, total: int, held: tuple[int, ...]) -> tuple[int, int, int] | None:
        if total < 3 or total in self.no_triple:
            return None
        self.passed_over = False
        for first in np.flatnonzero(self.counts[: total - 1])[::-1].tolist():
            if not self._enough((*held, first)):
                self.passed_over = True
            elif two := self.pair(total - first, (*held, first)):
                return first, *two
        if not self.passed_over:
            self.no_triple.add(total)
        return None

    def fill(self, length: int, gap: int, pieces: int) -> tuple[int, ...] | None:
        """``pieces`` lengths that sum to the gap beside a piece of ``length``, all of them there at once."""
        if pieces == 1:
            return (gap,) if self._enough((length, gap)) else None
        return self.pair(gap, (length,)) if pieces == 2 else self.triple(gap, (length,))


Kinds = list[tuple[int, list[tuple[int, int]]]]


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Kinds:
    """(how many sequences, [(length, how many of it), ...]) for every kind of sequence.

    Exact fills use up the short pieces that long ones without a complement would need, so plans with complements
    of up to one, two and three pieces are made, and the one of fewest sequences counts.
    """
    return min((_plan(histogram, capacity, depth) for depth in (3, 2, 1)), key=lambda kinds: sum(many for many, _ in kinds))


def _plan(histogram: dict[int, int], capacity: int, depth: int) -> Kinds:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    kinds: Kinds = []
    if counts[capacity]:
        kinds.append((int(counts[capacity]), [(capacity, 1)]))
        counts[capacity] = 0
    index = Complements(counts)
    for pieces, length in itertools.product(range(1, depth + 1), range(capacity - 1, 0, -1)):
        while counts[length] > 0 and (found := index.fill(length, capacity - length, pieces)):
            parts = Counter((length, *found))
            many = min(int(counts[x]) // n for x, n in parts.items())
            for x, n in parts.items():
                counts[x] -= many * n
            kinds.append((many, sorted(parts.items(), reverse=True)))
    # Best fit for the rest: open sequences by the room they have left.
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    open_rooms = np.zeros(capacity + 1, bool)

    def put(many: int, parts: list[tuple[int, int]], left: int) -> None:
        if many:
            room.setdefault(left, []).append((many, parts))
            open_rooms[left] = True

    for length in range(capacity, 0, -1):
        c = int(counts[length])
        while c > 0:
            at = int(np.argmax(open_rooms[length:])) + length
            if open_rooms[at]:
                many, parts = room[at].pop()
                open_rooms[at] = bool(room[at])
            else:
                at, many, parts = capacity, -(-c // (capacity // length)), []
            each = at // length
            full = min(many, c // each)
            put(full, [*parts, (length, each)], at - each * length)
            c -= full * each
            many -= full
            if many and c:  # fewer are left than fit one sequence
                put(1, [*parts, (length, c)], at - c * length)
                c, many = 0, many - 1
            if many and parts:
                put(many, parts, at)
    return kinds + [kind for kinds_left in room.values() for kind in kinds_left]


def _places(kinds: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, pieces in one sequence, first sequence, offset), by length and rank."""
    taken: Counter[int] = Counter()
    rows, sequence = [], 0
    for many, parts in kinds:
        offset = 0
        for length, n in parts:
            rows.append((length, taken[length], n, sequence, offset))
            taken[length] += many * n
            offset += length * n
        sequence += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(places: np.ndarray):
    key = places[:, 0] << 48 | places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            found = places[np.searchsorted(key, length << 48 | rank, "right") - 1]
            within = rank - found[:, 1]
            columns = {
                "sequence_id": pa.array(found[:, 3] + within // found[:, 2]),
                "offset": pa.array(found[:, 4] + within % found[:, 2] * length),
            }
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *columns.values()], [*kept, *columns])

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """``pieces`` (row, piece, length and any others) with ``sequence_id`` and ``offset``.

    ``pieces`` is read several times: give a stored table. Ranks are dealt by length and bucket, and each length has as many
    buckets as its own count asks for, so a length that many pieces share is split like any other.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # One row per length: at most ``capacity``.
    buckets = [(length, min(MAX_BUCKETS, -(-n // bucket_pieces))) for length, n in histogram.items()]
    known = F.broadcast(pieces.sparkSession.createDataFrame(buckets, "length bigint, _buckets bigint"))
    # `_`-names can't clash with what callers bring.
    bucketed = pieces.join(known, "length").withColumn("_bucket", F.pmod(F.xxhash64("row", "piece"), F.col("_buckets")))
    counted = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.Window.partitionBy("length").orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1))
    firsts = counted.select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_first"))
    own = F.row_number().over(W.Window.partitionBy("length", "_bucket").orderBy("row", "piece"))
    ranked = bucketed.withColumn("_own", own).join(firsts, ["length", "_bucket"]).withColumn("rank", F.col("_first") + F.col("_own") - 1)
    wanted = ranked.select(*pieces.columns, "rank")
    added = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    schema = T.StructType([*pieces.schema.fields, *added])
    return wanted.mapInArrow(_place(_places(plan_packing(histogram, capacity))), schema)


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    pieces, _ = staged(cut_pieces(docs, path or public_tokenizers.path("word_bpe_49k.json")).drop("ids"), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of all documents and their places in sequences."""
    return pack_documents(docs)
