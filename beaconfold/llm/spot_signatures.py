"""Document fingerprints of spot signatures.

A spot is a common word (an anchor, which prose of any subject is full of) and the chain of the next ``CHAIN`` content words,
``STRIDE`` apart; the start of a text counts as an anchor, so any text with a content word has a spot. Menus and lists
hold few anchors and so weigh little. A fingerprint is the set of spots, where the n-th occurrence of a spot is an
element of its own; as text it is their sorted 64-bit hashes in hex.

Likeness is the Jaccard similarity of two fingerprints. Sets are partitioned by their length so that two sets of
similarity ``at_least`` lie in the same or neighbouring parts; pairs further apart are pruned unseen, and a
comparison ends as soon as what is left of the two sorted sets can't reach ``at_least``. With ``at_least`` 0 all are exact.

Words are runs of ASCII letters and digits and of characters beyond ASCII, in lower case. A text is hashed in stretches of
bounded size, so a long one takes about twice its size in memory; one word of over ``LONG_WORD`` bytes is hashed by itself.

Defined results: null text is empty; a text without words has the empty fingerprint, and two empty ones have likeness
1; equal texts have equal fingerprints; rows equal in id and text give each their row; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.llm.common import plain_text, table
from beaconfold.llm.hashing import RangeHasher, mix, text_bytes
from beaconfold.llm.succession import with_next

#: Articles, forms of "to be", prepositions and conjunctions, by language; about every sixth word of prose.
ANCHORS = {
    "en": "a an the is was are be to of that there said".split(),
    "fr": "le la les un une des est était du que dans il".split(),
    "de": "der die das ein eine ist war den von zu dem es".split(),
    "es": "el los las una es era del que en por con se".split(),
}
CHAIN, STRIDE = 2, 1
STRETCH, LONG_WORD = 256 << 10, 64 << 10
#: Characters of text that are fingerprinted at a time, and rows that become Python objects at a time.
GROUP, ROWS = 2 << 20, 500
FOUND = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_WORD = np.zeros(256, bool)
for _first, _last in ("09", "AZ", "az"):
    _WORD[ord(_first) : ord(_last) + 1] = True
_WORD[0x80:] = True
_K = np.uint64(0x9E3779B97F4A7C15)


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of consecutive texts, and each text's bounds among them."""
    inside = _WORD[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    starts[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    hashes = np.zeros(len(a), np.uint64)
    long = np.flatnonzero(b - a > LONG_WORD)
    for k in long:
        hashes[k] = xxhash.xxh3_64_intdigest(data[a[k] : b[k]])
    first = 0
    while first < len(a):
        last = max(first + 1, int(np.searchsorted(b, a[first] + STRETCH, "right")))
        own = np.arange(first, last)
        own = own[b[own] - a[own] <= LONG_WORD]
        if len(own):
            lo, hi = a[own[0]], b[own[-1]]
            # A long word between short ones would make the stretch long.
            if hi - lo <= 2 * STRETCH:
                hashes[own] = RangeHasher(data[lo:hi]).ranges(a[own] - lo, b[own] - lo)
            else:
                for k in own:
                    hashes[k] = RangeHasher(data[a[k] : b[k]]).ranges(np.array([0]), b[k : k + 1] - a[k])[0]
        first = last
    return hashes, np.searchsorted(a, bounds)


def _anchor_hashes() -> np.ndarray:
    words = pa.array(sorted({w for own in ANCHORS.values() for w in own}))
    return np.unique(_words(*text_bytes(words))[0])


_ANCHORS = _anchor_hashes()


def spots(texts: list[str], chain: int = CHAIN, stride: int = STRIDE) -> list[np.ndarray]:
    """The fingerprint of each text as sorted distinct hashes."""
    data, bounds = text_bytes(pc.utf8_lower(pa.array(texts, pa.large_string())))
    words, of = _words(data, bounds)
    n = len(texts)
    text = np.repeat(np.arange(n), np.diff(of))
    anchor = _ANCHORS[np.minimum(np.searchsorted(_ANCHORS, words), len(_ANCHORS) - 1)] == words
    content = words[~anchor]
    before = np.concatenate([[0], np.cumsum(~anchor)])  # content words before each word
    ends = before[of[1:]]
    # Anchors: where they are among content words, their hash and their text. The start of each text comes first.
    at = np.concatenate([before[of[:-1]], before[:-1][anchor]])
    spot = np.concatenate([np.zeros(n, np.uint64), words[anchor]])
    home = np.concatenate([np.arange(n), text[anchor]])
    real = at < ends[home]
    at, spot, home = at[real], spot[real], home[real]
    for k in range(chain):
        place = at + k * stride
        there = place < ends[home]
        word = np.where(there, content[np.minimum(place, len(content) - 1)] if len(content) else 0, np.uint64(0))
        spot = mix(spot * _K + word + np.uint64(k + 1))
    order = np.lexsort((spot, home))
    spot, home = spot[order], home[order]
    new = np.ones(len(spot), bool)
    new[1:] = (spot[1:] != spot[:-1]) | (home[1:] != home[:-1])
    run = np.flatnonzero(new)
    nth = np.arange(len(spot)) - np.repeat(run, np.diff(np.append(run, len(spot))))
    spot = np.where(nth > 0, mix(spot + nth.astype(np.uint64) * _K), spot)
    cuts = np.searchsorted(home, np.arange(n + 1))
    return [np.unique(spot[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def length_part(size: int, at_least: float) -> int:
    """The part of sets of this length: two sets of similarity ``at_least`` are in the same part or in neighbouring ones."""
    return 0 if at_least <= 0 or size == 0 else int(math.log(size) / -math.log(min(at_least, 0.999)) + 1e-9) + 1


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float | None:
    """Jaccard similarity of two sorted sets, None if it is below ``at_least``."""
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if len(a) < at_least * len(b) or abs(length_part(len(a), at_least) - length_part(len(b), at_least)) > 1:
        return None
    # The shorter set in steps; b's elements up to the same hash are done with it.
    common, done, step = 0, 0, max(256, len(a) // 16)
    needed = at_least * (len(a) + len(b)) / (1 + at_least)
    for first in range(0, len(a), step):
        part = a[first : first + step]
        upto = int(np.searchsorted(b, part[-1], "right"))
        common += len(np.intersect1d(part, b[done:upto], assume_unique=True))
        done = upto
        if common + min(len(a) - first - len(part), len(b) - done) < needed - 1e-9:
            return None
    found = common / (len(a) + len(b) - common)
    return found if found >= at_least else None


def hex_text(found: np.ndarray) -> str:
    return found.astype(">u8").tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole, at in ((b, k) for b in batches for k in range(0, len(b), ROWS)):
        batch = whole.slice(at, ROWS)
        texts = batch.column("text").to_pylist()
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= GROUP):
                size += len(texts[last])
                last += 1
            found = spots(texts[first:last])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(first, last - first),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([length_part(len(f), 0.8) for f in found], pa.int32()),
                    pa.array(map(hex_text, found), pa.string()),
                ],
                ["row", "n_spots", "length_part", "fingerprint"],
            )
            first = last


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Documents as (row, n_spots, length_part, fingerprint); ``row`` holds all columns but the text. No shuffle."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    read = docs.select(F.struct(*kept).alias("row"), plain_text().alias("text"))
    added = [T.StructField("n_spots", T.LongType()), T.StructField("length_part", T.IntegerType()), T.StructField("fingerprint", T.StringType())]
    return read.mapInArrow(_prints, T.StructType([read.schema["row"], *added]))


def edited(text: str, following: str) -> str:
    """A text whose last third is replaced by as much of the beginning of another."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compared(group: list[tuple]) -> list[tuple]:
    """Result rows of a run of (part, last, doc_id, text, times); the final one only follows."""
    own = spots([g[3] for g in group])
    wanted = []
    for k, ((part, last, doc, text, times), after) in enumerate(zip(group[:-1], group[1:], strict=True)):
        if last:
            continue
        if part != after[0]:
            raise ValueError(f"part {part} has no end")
        if times > 1:
            wanted.append((k, doc, text, times - 1, text, k))
        wanted.append((k, doc, text, 1, after[3], k + 1))
    changed = [edited(text, following) for _, _, text, _, following, _ in wanted]
    prints = spots(changed)
    rows = []
    for (k, doc, text, times, _, after), new, print_ in zip(wanted, changed, prints, strict=True):
        digest = hashlib.sha256(new.encode()).hexdigest()
        row = (doc, len(text), digest, hex_text(own[k]), hex_text(print_), likeness(own[k], print_), likeness(own[k], own[after]))
        rows.append((row, times))
    return rows


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in FOUND.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    once = [row for row, _ in rows]
    if once:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*once, strict=True), types, strict=True)], names)
    for row, times in rows:
        # Repeated rows are given out in small batches, however many they are.
        for left in range(times - 1, 0, -64):
            part = [row] * min(64, left)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for first in range(0, len(batch), ROWS):
            part = batch.slice(first, ROWS)
            for row in zip(*(part.column(c).to_pylist() for c in ("part", "last", "doc_id", "text", "times")), strict=True):
                held.append(row)
                size += len(row[3])
                if size > GROUP and len(held) > 1:
                    yield from _batches(_compared(held))
                    held, size = held[-1:], len(held[-1][3])
    if held:
        yield from _batches(_compared(held))


def op12_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(table(spark, sf_dir, "documents")).drop("key").mapInArrow(_compare, FOUND)
