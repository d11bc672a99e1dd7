"""Fill-in-middle transformation with cuts found in a Fenwick tree.

A text is a row of units, ``[A-Za-z]+|[^A-Za-z]`` from left to right over code points. Its bytes fall into blocks of a
fixed size; for each block two counts are kept in a Fenwick tree: units that start in it and code points that start in it.
A cut after ``a`` units is found by binary-lifting descent, which gives the last block that has at most ``a`` units
before it and the code points before that block; the boundary is then located inside this one block. Counting goes
through a text in windows of whole blocks, so memory beyond the text itself is bounded. Map-only: no shuffle.

A unit starts at every first byte of a code point, but not at a letter after a letter; so units can be counted on
bytes, and a block border inside a unit is no special case.

Defined results: null text is empty and stays plain; a null doc_id draws from ``seed:`` followed by nothing; rows equal in id
and text give equal rows; an empty table gives an empty one; other columns stay, in the struct ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.llm.common import plain_text, table
from beaconfold.llm.hashing import text_bytes

BLOCK = 1024
#: Blocks counted at a time.
WINDOW = 1024
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, how many stay as they are, and how many of the others put the suffix first.
PLAIN_SHARE, SPM_SHARE = 10, 20
ADDED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
#: Bytes at which a code point starts.
_START = (np.arange(256) & 0xC0) != 0x80


def _starts(data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """For bytes ``lo`` to ``hi`` of a text: where units start, and where code points do."""
    part = data[lo:hi]
    points, letters = _START[part], _LETTER[part]
    inside = letters.copy()
    inside[1:] &= letters[:-1]
    inside[:1] &= lo > 0 and bool(_LETTER[data[lo - 1]])
    return points & ~inside, points


class Fenwick:
    """Prefix sums of several counts per block, with descent by the first of them."""

    def __init__(self, counts: np.ndarray):
        """``counts``: one row per block."""
        self.n = len(counts)
        before = np.zeros((self.n + 1, counts.shape[1]), np.int64)
        np.cumsum(counts, axis=0, out=before[1:])
        at = np.arange(self.n + 1)
        self.tree = before - before[at & (at - 1)]

    def total(self) -> np.ndarray:
        at, out = self.n, np.zeros(self.tree.shape[1], np.int64)
        while at:
            out += self.tree[at]
            at &= at - 1
        return out

    def descend(self, target: int) -> tuple[int, np.ndarray]:
        """The last block with at most ``target`` before it by the first count, and all counts before it."""
        at, before = 0, np.zeros(self.tree.shape[1], np.int64)
        step = 1 << self.n.bit_length()
        while step := step >> 1:
            if at + step <= self.n and before[0] + self.tree[at + step, 0] <= target:
                at += step
                before = before + self.tree[at]
        return at, before


class UnitIndex:
    """Units and code points of one text, by its UTF-8 bytes."""

    def __init__(self, data: np.ndarray, block: int = BLOCK, window: int = WINDOW):
        self.data, self.block = data, block
        counts = np.zeros((-(-len(data) // block), 2), np.int64)
        for lo in range(0, len(data), block * window):
            hi = min(lo + block * window, len(data))
            edges = np.arange(0, hi - lo, block)
            first = lo // block
            for k, flags in enumerate(_starts(data, lo, hi)):
                counts[first : first + len(edges), k] = np.add.reduceat(flags, edges, dtype=np.int64)
        self.tree = Fenwick(counts)
        self.units, self.points = (int(x) for x in self.tree.total())

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units >= self.units:
            return len(self.data), self.points
        block, before = self.tree.descend(units)
        lo = block * self.block
        starts, points = _starts(self.data, lo, min(lo + self.block, len(self.data)))
        at = int(np.flatnonzero(starts)[units - int(before[0])])
        return lo + at, int(before[1]) + int(np.count_nonzero(points[:at]))


def draws(seed: int, doc_id: int | None) -> tuple[int, ...]:
    """Four unsigned 32-bit draws of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int(x) for x in np.frombuffer(digest, ">u4", 4))


def transform(data: np.ndarray, doc_id: int | None, seed: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix, of middle, output) of one text."""
    h1, h2, h3, h4 = draws(seed, doc_id)
    index, text = UnitIndex(data), data.tobytes()
    if not text or h3 % 100 >= 100 - PLAIN_SHARE or any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return index.units, "plain", None, None, text
    first, last = sorted((h1 % (index.units + 1), h2 % (index.units + 1)))
    (a, a_points), (b, b_points) = index.cut(first), index.cut(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_SHARE:
        form, parts = "spm", (SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle)
    else:
        form, parts = "psm", (PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)
    return index.units, form, a_points, b_points - a_points, b"".join(parts)


def _transformed(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            rows = [transform(data[a:b], doc, seed) for doc, a, b in zip(ids, bounds[:-1], bounds[1:], strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.binary()).cast(pa.string()),
                ],
                ["row", *ADDED.names],
            )

    return run


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Documents (doc_id, text, any others) as (row, n, form, prefix_chars, middle_chars, output).

    ``row`` holds all columns but the text, whatever their names; ``output`` is what a model is trained on.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    read = docs.select(F.struct(*kept).alias("row"), "doc_id", plain_text().alias("text"))
    schema = T.StructType([read.schema["row"], *ADDED.fields])
    return read.mapInArrow(_transformed(seed), schema)


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form.

    A marker can't arise where parts meet, as it starts with its only ``<``; so the first one after another is the real one.
    """

    def after(text: Column, head: Column) -> Column:
        """What follows a leading part and the marker behind it."""
        return F.substr(text, F.length(head) + 4)

    body = F.substr(output, F.lit(4))
    one = F.when(form == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    rest = after(body, one)
    two = F.substring_index(rest, MIDDLE, 1)
    three = after(rest, two)
    prefix, suffix = F.when(form == "psm", one).otherwise(two), F.when(form == "psm", two).otherwise(one)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, three, suffix))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h
    FROM documents
), k AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
        CAST('0x' || h[17:24] AS BIGINT) % 100 AS r3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS r4
    FROM d
), p AS (
    SELECT *, array_to_string(u[1:least(c1, c2)], '') AS pre, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
        array_to_string(u[greatest(c1, c2) + 1:], '') AS suf,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 90 THEN 'plain'
            WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""
