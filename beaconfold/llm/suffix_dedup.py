"""Removal of repeated byte strings with a logarithmic family of sparse suffix arrays.

A byte goes if some ``match`` bytes around it start anywhere else too. Storing every suffix of the corpus is out of
proportion, so suffixes are sampled by content: of the ``gram``-byte strings inside each ``match``-byte window, the one of
least hash is the window's anchor. Equal windows have equal anchors at the same distance, wherever they stand. Windows
next to each other with the same anchor make a span; an index entry is (suffix, span): the anchored suffix by its first
four bytes and a fingerprint of its first ``gram``, which is its order in the array, and a fingerprint of the span.

1. Each task turns its batches into entries; equal ones are added up before the shuffle, which goes by suffix. In each
   partition the index family takes every incoming batch: it is sorted (its suffix array), merge-scanned against the
   levels, becomes a level, and levels of like size merge. At the end, spans found twice are repeats in whole; spans
   that share a suffix but differ may share a part.
2. Of those, one for each different span, every window is compared by fingerprint, counted with partial sums.
3. Documents take the marks back, and remove what the marked windows cover.

So no group is ever paired with itself, and a passage that a third of all documents hold is one entry a task. Windows are equal if
64-bit fingerprints are (spans: 128 bits with their suffix).

Defined results: null text is empty; texts under ``match`` bytes lose nothing; equal rows are separate documents; matches
never cross documents; rows are told apart by a key of id and text, so equal ids are fine.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.llm.common import discard, row_key, staged, table
from beaconfold.llm.hashing import RangeHasher, groups_of, text_bytes

MATCH, GRAM = 400, 240
#: Texts are hashed in runs of about this size: the arrays of 64-bit numbers stay in a core's own cache.
GROUP_BYTES = 1 << 17
#: Longer runs of bytes are worked on in pieces; places within a piece must fit PLACE_BITS.
PIECE_BYTES = 4 << 20
PLACE_BITS = 23

SPANS = "row bigint, first int, last int, suffix bigint, span bigint"
ENTRIES = "suffix bigint, span bigint, n bigint, place bigint"
MARKS = ENTRIES + ", shared boolean"


def anchored_spans(data: np.ndarray, bounds: np.ndarray, match: int = MATCH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Spans of consecutive texts: first and last window start, suffix key, span fingerprint."""
    if len(data) < match:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    if len(data) > PIECE_BYTES + match:
        # Windows start in one piece each; a span that ends at a piece's end just has a fingerprint of its own.
        parts = []
        for lo in range(0, len(data), PIECE_BYTES):
            hi = min(len(data), lo + PIECE_BYTES + match - 1)
            first, last, *keys = anchored_spans(data[lo:hi], np.clip(bounds, lo, hi) - lo, match, gram)
            parts.append((first + lo, last + lo, *keys))
        return tuple(map(np.concatenate, zip(*parts, strict=True)))
    hasher = RangeHasher(data)
    tags = hasher.windows(gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    # Hash above, place below: the least is the leftmost of the least hashes.
    best = (tags & ~low) | np.arange(len(tags), dtype=np.uint64)
    width, done = match - gram + 1, 1
    while done < width:
        step = min(done, width - done)
        best = np.minimum(best[:-step], best[step:])
        done += step
    anchor = (best & low).astype(np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    anchor[np.arange(len(anchor)) + match > ends[: len(anchor)]] = -1
    first = np.flatnonzero(np.diff(anchor, prepend=-2))
    last = np.append(first[1:], len(anchor)) - 1
    inside = anchor[first] >= 0
    first, last = first[inside], last[inside]
    at = anchor[first]
    head = np.zeros(len(at), np.uint64)
    for k in range(4):
        head = head << np.uint64(8) | data[at + k].astype(np.uint64)
    return first, last, head << np.uint64(32) | (tags[at] & np.uint64(0xFFFFFFFF)), hasher.ranges(first, last + match)


class IndexFamily:
    """Sorted arrays of entries in levels; a new batch is a level, and levels of like size merge."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, ...]] = []

    @staticmethod
    def _sorted(suffix, span, n, place) -> tuple[np.ndarray, ...]:
        """Ordered by suffix and span, equal entries added up; the least place stands for them."""
        order = np.lexsort((place, span, suffix))
        suffix, span, n, place = suffix[order], span[order], n[order], place[order]
        new = np.ones(len(suffix), bool)
        new[1:] = (suffix[1:] != suffix[:-1]) | (span[1:] != span[:-1])
        at = np.flatnonzero(new)
        return suffix[at], span[at], np.add.reduceat(n, at) if len(at) else n, place[at]

    def add(self, suffix: np.ndarray, span: np.ndarray, n: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Takes a batch in; returns the suffixes of it that stood in a level already."""
        batch = self._sorted(suffix, span, n, place)
        known = np.zeros(len(batch[0]), bool)
        for level in self.levels:
            at = np.searchsorted(level[0], batch[0])
            known |= level[0][np.minimum(at, len(level[0]) - 1)] == batch[0]
        if len(batch[0]):
            self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            self._merge()
        return batch[0][known]

    def _merge(self) -> None:
        upper, lower = self.levels.pop(), self.levels.pop()
        self.levels.append(self._sorted(*(np.concatenate(x) for x in zip(lower, upper, strict=True))))

    def matches(self) -> tuple[np.ndarray, ...]:
        """All entries that occur twice or share their suffix with another span; last, whether they share it."""
        while len(self.levels) > 1:
            self._merge()
        if not self.levels:
            none = np.zeros(0, np.int64)
            return none.view(np.uint64), none.view(np.uint64), none, none, none.astype(bool)
        suffix, span, n, place = self.levels[0]
        next_same = np.append(suffix[1:] == suffix[:-1], False)
        shared = next_same | np.append(False, next_same[:-1])
        wanted = shared | (n > 1)
        return suffix[wanted], span[wanted], n[wanted], place[wanted], shared[wanted]


def _longs(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(a).view(np.int64)) for a in arrays]


def _each_group(batch: pa.RecordBatch, match: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text's number, first, last, suffix, span) of a batch's spans, a group of texts at a time."""
    data, bounds = text_bytes(batch.column("text"))
    for a, b in groups_of(bounds, GROUP_BYTES):
        own = bounds[a : b + 1] - bounds[a]
        first, last, suffix, span = anchored_spans(data[bounds[a] : bounds[b]], own, match, gram)
        text = np.searchsorted(own, first, "right") - 1
        yield a + text, first - own[text], last - own[text], suffix, span


def _entries(match: int, gram: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            found = [(suffix, span, rows[text]) for text, _, _, suffix, span in _each_group(batch, match, gram)]
            if found:
                suffix, span, place = map(np.concatenate, zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(_longs(*IndexFamily._sorted(suffix, span, np.ones(len(suffix), np.int64), place)), ["suffix", "span", "n", "place"])

    return entries


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    family = IndexFamily()
    for batch in batches:
        suffix, span, n, place = (c.to_numpy() for c in batch.columns)
        family.add(suffix.view(np.uint64), span.view(np.uint64), n, place)
    *columns, shared = family.matches()
    for at in range(0, len(shared), 100_000):
        part = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays([*_longs(*(c[part] for c in columns)), pa.array(shared[part])], ["suffix", "span", "n", "place", "shared"])


def _spans(match: int, gram: int):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for text, first, last, suffix, span in _each_group(batch, match, gram):
                where = [pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*_longs(rows[text]), *where, *_longs(suffix, span)], ["row", "first", "last", "suffix", "span"])

    return spans


def open_runs(spans: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and text of the open stretches of some texts, in order; neighbouring spans are one stretch."""
    found = pc.list_flatten(spans)
    text = pc.list_parent_indices(spans).to_numpy().astype(np.int64)
    first, last = (bounds[text] + pc.struct_field(found, name).to_numpy() for name in ("first", "last"))
    order = np.argsort(first, kind="stable")
    text, first, last = text[order], first[order], last[order]
    new = np.ones(len(first), bool)
    new[1:] = first[1:] != last[:-1] + 1
    at = np.flatnonzero(new)
    n = last[np.append(at[1:], len(last))[: len(at)] - 1] - first[at] + 1
    # Long stretches are cut, so that a group of them stays small.
    parts = -(-n // GROUP_BYTES)
    skip = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * GROUP_BYTES
    return np.repeat(first[at], parts) + skip, np.minimum(np.repeat(n, parts) - skip, GROUP_BYTES), np.repeat(text[at], parts)


def _windows(match: int, with_place: bool):
    """Fingerprints of all windows in a row's open spans, a group of stretches at a time."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            rows = batch.column("row").to_numpy()
            first, n, text = open_runs(batch.column("open"), bounds)
            held = np.append(0, np.cumsum(n + match - 1))
            for a, b in groups_of(held, 2 * GROUP_BYTES):
                own = n[a:b]
                hashed = RangeHasher(np.concatenate([data[x : x + m + match - 1] for x, m in zip(first[a:b].tolist(), own.tolist(), strict=True)]))
                # Windows over the end of a stretch are left out.
                inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
                tags = hashed.windows(match)[inside + np.repeat(held[a:b] - held[a], own)]
                columns = _longs(tags)
                if with_place:
                    columns += _longs(np.repeat(rows[text[a:b]], own))
                    columns.append(pa.array((inside + np.repeat(first[a:b] - bounds[text[a:b]], own)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["tag", "row", "at"][: len(columns)])

    return windows


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
PLACES = "array<struct<first:int,last:int>>"
LOOKED = f"{RESULT}, row bigint, text string, full {PLACES}, open {PLACES}"


def _outcome(doc, text: pa.Scalar, full: pa.Scalar, hits: pa.Scalar | None, match: int, with_text: bool) -> tuple:
    """A document's row of RESULT, from marked ranges of window starts and single ones."""
    data = np.frombuffer(text.as_buffer(), np.uint8)
    none = np.zeros(0, np.int64)
    first, last = (pc.struct_field(full.values, name).to_numpy() for name in ("first", "last")) if full.is_valid else (none, none)
    single = hits.values.to_numpy() if hits is not None and hits.is_valid else none
    starts, ends = np.concatenate([first, single]), np.concatenate([last, single]) + match
    if not len(starts):
        return doc, len(data), 0, 0, sha256(data).hexdigest(), data.tobytes() if with_text else None
    edges = np.bincount(starts, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1)
    gone = np.cumsum(edges[:-1]) > 0
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0])
    kept = data[~gone].tobytes()
    return doc, len(data), int(np.count_nonzero(gone)), runs, sha256(kept).hexdigest(), kept if with_text else None


_RESULT_TYPES = [pa.int64()] * 4 + [pa.string(), pa.binary()]
_RESULT_NAMES = [field.split()[0] for field in RESULT.split(", ")]


def _first_look(match: int, with_text: bool):
    """Finishes documents without an open span; the others keep their text for a second look."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waits = pc.fill_null(pc.greater(pc.list_value_length(batch.column("open")), 0), False)
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("full"), waits.to_pylist(), strict=True)
            out = [(doc, *[None] * 5) if wait else _outcome(doc, text, full, None, match, with_text) for doc, text, full, wait in rows]
            columns = list(zip(*out, strict=True)) or [[]] * len(_RESULT_TYPES)
            held = [batch.column("row"), *(pc.if_else(waits, batch.column(c), pa.scalar(None, batch.column(c).type)) for c in ("text", "full", "open"))]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, _RESULT_TYPES, strict=True)), *held], [*_RESULT_NAMES, "row", "text", "full", "open"])

    return look


def _second_look(match: int, with_text: bool):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("full"), batch.column("hits"), strict=True)
            out = [_outcome(doc, text, full, hits, match, with_text) for doc, text, full, hits in rows]
            columns = list(zip(*out, strict=True)) or [[]] * len(_RESULT_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _RESULT_TYPES, strict=True)], _RESULT_NAMES)

    return look


def remove_repeats(docs: DataFrame, match: int = MATCH, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of ``docs`` (doc_id, text); ``kept`` holds the remaining
    bytes, or null without ``with_text``."""
    spark = docs.sparkSession
    read = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    source = read.select("row", "text")
    entries = source.mapInArrow(_entries(match, gram), ENTRIES)
    marks, marks_at = staged(entries.repartition("suffix").mapInArrow(_index, MARKS), "marks")
    spans = source.mapInArrow(_spans(match, gram), SPANS).join(marks, ["suffix", "span"])
    place = F.struct("first", "last")
    is_open = F.col("shared") & ((F.col("n") == 1) | (F.col("row") == F.col("place")))
    marked = spans.groupBy("row").agg(
        F.collect_set(F.when(F.col("n") > 1, place)).alias("full"), F.collect_set(F.when(is_open, place)).alias("open")
    )
    marked, marked_at = staged(marked.withColumnRenamed("row", "_row"), "marked")
    discard(spark, marks_at)
    joined = read.join(marked, F.col("row") == F.col("_row"), "left").drop("_row")
    looked, _ = staged(joined.mapInArrow(_first_look(match, with_text), LOOKED), "looked")
    discard(spark, marked_at)
    pending = looked.where("text IS NOT NULL")
    opened = pending.select("row", "text", "open")
    twice = opened.mapInArrow(_windows(match, False), "tag bigint").groupBy("tag").agg(F.count("*").alias("n")).where("n > 1").select("tag")
    hits = opened.mapInArrow(_windows(match, True), "tag bigint, row bigint, at int").join(twice, "tag")
    hits = hits.groupBy(F.col("row").alias("_row")).agg(F.collect_set("at").alias("hits"))
    second = pending.select("doc_id", "row", "text", "full").join(hits, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "full", "hits")
    names = [field.split()[0] for field in RESULT.split(", ")]
    return looked.where("text IS NULL").select(names).unionByName(second.mapInArrow(_second_look(match, with_text), RESULT))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
