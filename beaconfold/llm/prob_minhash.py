"""Near-duplicate classes by ProbMinHash, banding and verification.

A document's shingles (five words) weigh as often as they occur. Each shingle is a Poisson process with its weight as
rate; an arrival goes to one random register, which keeps the earliest. A shingle stops when its next arrival is later
than all registers. Two documents share a register's winner with the probability Jaccard similarity of their weights.
A text with repeated shingles is signed once more with all weights 1, for which that is plain Jaccard; without repeats
both signatures are the same one. Registers make bands, the same for both kinds; documents that share a band are candidates, and a
candidate pair is a link if the exact similarity of its shingles, probability Jaccard or plain Jaccard, is ``threshold`` or more. Classes are the connected
components of the links.

Texts with the same words are one text from the start: one signature stands for all copies, and a class row is given
to each document. Within a band, documents are not paired with one another: each is compared with its least and
greatest member by node, and what is linked is one class from then on. Bands that still hold several classes, for example
of texts around one common passage, are then compared whole, in blocks of a bounded number of members, their largest class only
with the others; two members that meet in several bands are compared in the largest one, and where most members of a band meet in a
larger one, these go to blocks with the others only. So no link within a band is lost.
Shingles are told apart by 32 bits of their hash: two texts of 20,000 words have about 0.1 of them equal by chance, which
matters for a similarity within 0.00001 of the threshold only.

Defined results: null and empty texts have no shingle and are one class; a text of fewer than five words is one
shingle; class_id is the least doc_id of the class, null only if it has no other; other columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.llm.common import apply_copies, discard, row_key, staged, table
from beaconfold.llm.components import components
from beaconfold.llm.hashing import groups_of, mix, text_bytes, word_hashes

WORDS, BANDS, ROWS, THRESHOLD = 5, 24, 4, 0.8
GROUP_BYTES = 1 << 20
#: About how many members of each of two sides a block has, and how many shingles it looks at in one go.
BLOCK_MEMBERS, BLOCK_COLUMNS = 128, 4096
SIGNED = "doc_id bigint, row bigint, node binary, bands array<bigint>, shingles binary"


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int = WORDS) -> list[np.ndarray]:
    """Each text's sorted shingle hashes, repeats included."""
    n = len(words)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled[: n - k] = mix(rolled[: n - k] + words[k:] * np.uint64(2 * k + 1))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= size:
            out.append(np.sort(rolled[a : b - size + 1]))
        elif b > a:
            out.append(mix(words[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)).sum(dtype=np.uint64, keepdims=True))
        else:
            out.append(words[:0])
    return out


def prob_minhash(shingles: list[np.ndarray], registers: int) -> np.ndarray:
    """A row of winners for each text; texts without shingles get zeros."""
    sizes = np.array([len(s) for s in shingles])
    flat = np.concatenate(shingles) if len(shingles) else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(shingles)), sizes)
    new = np.ones(len(flat), bool)
    new[1:] = (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(at, append=len(flat)).astype(np.float64)
    flat, doc = flat[at], doc[at]
    times = np.full(len(shingles) * registers, np.inf)
    winners = np.zeros(len(shingles) * registers, np.uint64)
    arrival = np.zeros(len(flat))
    turn = 0
    while len(flat):
        turn += 1
        draw = mix(flat + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        arrival = arrival - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        slot = doc * registers + (mix(draw) % np.uint64(registers)).astype(np.int64)
        early = arrival < times[slot]
        np.minimum.at(times, slot[early], arrival[early])
        won = early & (arrival == times[slot])
        winners[slot[won]] = flat[won]
        latest = times.reshape(-1, registers).max(axis=1)
        going = arrival < latest[doc]
        flat, doc, weight, arrival = flat[going], doc[going], weight[going], arrival[going]
    return winners.reshape(-1, registers)


def band_keys(shingles: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A row of band keys for each text: each from ``rows`` registers' winners and the band's number."""
    winners = prob_minhash(shingles, bands * rows)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(shingles), 1))
    for r in range(rows):
        keys = mix(keys + winners[:, r::rows])
    return keys


def _signer(bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            for first, last in groups_of(bounds, GROUP_BYTES):
                lo = bounds[first]
                words, ends = word_hashes(data[lo : bounds[last]], bounds[first : last + 1] - lo)
                shingles = shingle_hashes(words, ends)
                keys = [[k] if len(s) else [] for s, k in zip(shingles, band_keys(shingles, bands, rows), strict=True)]
                distinct = [np.unique(s) for s in shingles]
                repeated = [i for i, s in enumerate(shingles) if len(distinct[i]) < len(s)]
                if repeated:
                    for i, k in zip(repeated, band_keys([distinct[i] for i in repeated], bands, rows), strict=True):
                        keys[i].append(k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[first:last],
                        batch.column("row")[first:last],
                        pa.array([blake2b(words[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                        pa.array([np.unique(np.concatenate(k)).view(np.int64) if k else [] for k in keys], pa.list_(pa.int64())),
                        pa.array([(s >> np.uint64(32)).astype("<u4").tobytes() for s in shingles], pa.binary()),
                    ],
                    ["doc_id", "row", "node", "bands", "shingles"],
                )

    return sign


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The greater of plain and probability Jaccard of two sorted arrays with repeats."""
    if not len(a) or not len(b):
        return 0.0
    ha, wa = np.unique(a, return_counts=True)
    hb, wb = np.unique(b, return_counts=True)
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    plain = len(both) / (len(ha) + len(hb) - len(both))
    if not len(both) or (wa.max() == 1 and wb.max() == 1):
        return plain
    # Sum over common d of 1 / sum over e of max(a_e / a_d, b_e / b_d), with e sorted by b_e / a_e.
    ca, cb = wa[ia].astype(float), wb[ib].astype(float)
    order = np.argsort(cb / ca, kind="stable")
    ca, cb = ca[order], cb[order]
    only_a, only_b = wa.sum() - ca.sum(), wb.sum() - cb.sum()
    up_to = np.cumsum(ca)
    beyond = cb.sum() - np.cumsum(cb)
    return max(plain, float((1.0 / ((up_to + only_a) / ca + (beyond + only_b) / cb)).sum()))


def _verify(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            good = [similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) >= threshold for x, y in zip(left, right, strict=True)]
            yield batch.select(["ra", "rb"]).filter(pa.array(good, pa.bool_()))

    return verify


def _candidates(banded: DataFrame) -> DataFrame:
    """Pairs (a, b, ra, rb) of members of other classes with the two ends of each band; ``banded``: band, node, root.

    The ends are the least and greatest node (a hash itself), so bands of one class mostly have the same two, and
    links lead to the least node, which is the class's root.
    """
    member = F.struct("node", "root")
    hubs = banded.groupBy("band").agg(F.array(F.min(member), F.max(member)).alias("hubs"))
    pairs = banded.join(hubs, "band").select("node", "root", F.explode("hubs").alias("hub")).where("root <> hub.root")
    own, other = F.struct(F.col("node").alias("n"), F.col("root").alias("r")), F.struct(F.col("hub.node").alias("n"), F.col("hub.root").alias("r"))
    pairs = pairs.select(F.greatest(own, other).alias("x"), F.least(own, other).alias("y"))
    return pairs.select(F.col("x.n").alias("a"), F.col("y.n").alias("b"), F.col("x.r").alias("ra"), F.col("y.r").alias("rb")).distinct()


def _several(banded: DataFrame) -> DataFrame:
    """Of (band, node, root) only the bands that hold several classes."""
    several = banded.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("band")
    return banded.join(several, "band", "left_semi")


def _renamed(banded: DataFrame, roots: DataFrame) -> DataFrame:
    """``banded`` with new roots."""
    named = roots.withColumnsRenamed({"node": "_node", "root": "_root"})
    return banded.join(named, F.col("root") == F.col("_node"), "left").select("band", "node", F.coalesce("_root", "root").alias("root"))


def _sized(banded: DataFrame) -> DataFrame:
    """``banded`` with the number ``n`` of each band's members."""
    return banded.join(banded.groupBy("band").agg(F.count("*").alias("n")), "band")


def _blocks(banded: DataFrame) -> DataFrame:
    """(band, i, j, node, root): every two members of different classes meet in a block (i, j) of their largest common band at least.

    Some members of a band, its main ones, meet only the others: those of its largest class or, if they are more, those whose largest
    band is the same larger one, where they meet anyway. So a huge class beside few others is no burden, and a group that shares
    many bands isn't compared whole in each.
    """
    sized = _sized(banded)
    largest = sized.groupBy("node").agg(F.max(F.struct("n", "band")).alias("largest")).select(F.col("node").alias("_node"), F.col("largest.band").alias("kin"))
    members = sized.join(largest, F.col("node") == F.col("_node")).select("band", "node", "root", "n", "kin")
    by_root = members.groupBy("band", "n", "root").agg(F.count("*").alias("of_root"))
    by_kin = members.where("kin <> band").groupBy("band", "kin").agg(F.count("*").alias("of_kin"))
    most_root, most_kin = F.max(F.struct("of_root", "root")), F.max(F.struct("of_kin", "kin"))
    sizes = by_root.groupBy("band", "n").agg(most_root["root"].alias("main"), most_root["of_root"].alias("of_main"))
    sizes = sizes.join(by_kin.groupBy("band").agg(most_kin["kin"].alias("main_kin"), most_kin["of_kin"].alias("of_main_kin")), "band", "left")
    by = F.coalesce(F.col("of_main_kin") > F.col("of_main"), F.lit(False))
    sizes = sizes.select("band", "n", "main", "main_kin", by.alias("by_kin"), F.greatest("of_main", "of_main_kin").alias("inside")).where("of_main < n AND inside < n")
    parts = lambda n: F.ceil(n / F.lit(BLOCK_MEMBERS)).cast("int")
    sizes = sizes.select("band", "main", "main_kin", "by_kin", parts(F.col("n") - F.col("inside")).alias("others"), parts(F.col("inside")).alias("mains"))
    key = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    is_main = F.when(F.col("by_kin"), F.col("kin") == F.col("main_kin")).otherwise(F.col("root") == F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(is_main, F.col("mains")).otherwise(F.col("others")))
    others = F.sequence(F.lit(0), F.col("others") - 1)
    mains = F.sequence(F.col("others"), F.col("others") + F.col("mains") - 1)
    as_main = F.transform(others, lambda x: key(x, F.col("others") + F.col("own")))
    as_other = F.concat(
        F.transform(others, lambda x: key(F.least(F.col("own"), x.cast("bigint")), F.greatest(F.col("own"), x.cast("bigint")))),
        F.transform(mains, lambda x: key(F.col("own"), x)),
    )
    met = members.join(sizes, "band").withColumn("own", own)
    return met.select("band", "node", "root", F.explode(F.when(is_main, as_main).otherwise(as_other)).alias("key")).select("band", "key.i", "key.j", "node", "root")


def similar_in_block(texts: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which texts of a block are similar by plain Jaccard, and which others may be by probability Jaccard: two symmetric
    matrices."""
    k = len(texts)
    sets = [np.unique(x, return_counts=True) for x in texts]
    sizes = np.array([len(h) for h, _ in sets], np.float64)
    plain = np.array([w.max(initial=1) == 1 for _, w in sets])
    row = np.repeat(np.arange(k), sizes.astype(np.int64))
    flat = np.concatenate([h for h, _ in sets])
    share = np.concatenate([w / w.sum() for _, w in sets])
    _, column, n = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(n > 1)
    place = np.full(len(n), -1, np.int64)
    place[shared] = np.arange(len(shared))
    column = place[column]
    both, mass = np.zeros((k, k)), np.zeros((k, k))
    order = np.argsort(column, kind="stable")
    cuts = np.searchsorted(column[order], np.arange(0, len(shared) + BLOCK_COLUMNS, BLOCK_COLUMNS))
    for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        at = order[a:b]
        has, weight = np.zeros((2, k, BLOCK_COLUMNS), np.float32)
        has[row[at], column[at] - part * BLOCK_COLUMNS] = 1
        weight[row[at], column[at] - part * BLOCK_COLUMNS] = share[at]
        both += has @ has.T
        mass += weight @ has.T
    jaccard = both / np.maximum(sizes[:, None] + sizes[None, :] - both, 1)
    links = jaccard >= threshold
    # With the shares x and y that two texts have in common, probability Jaccard is at most 1 / (1/x + 1/y - 1): each term of
    # its sum is at most 1 / (1/a + (1 - y)/b), which is concave and homogeneous in the weights a and b.
    inverse = 1 / np.maximum(mass, 1e-9)
    maybe = ~links & (1 / (inverse + inverse.T - 1) >= threshold - 1e-4) & ~(plain[:, None] & plain[None, :])
    return links, maybe


def meet_first(bands: list[np.ndarray], band: int) -> np.ndarray:
    """Which members of a block have no lesser band in common than this one: a pair is compared in one band only."""
    lesser = [b[b < band] for b in bands]
    flat, row = np.concatenate(lesser), np.repeat(np.arange(len(bands)), [len(b) for b in lesser])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    first = np.ones((len(bands), len(bands)), bool)
    cuts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]])) if len(flat) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a > 1:
            first[np.ix_(row[a:b], row[a:b])] = False
    return first


def by_size(bands: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Each member's bands (n, band) as places in the order from the largest band down; all the bands and their places."""
    flat = pc.list_flatten(bands)
    n, band = (pc.struct_field(flat, name).to_numpy() for name in ("n", "band"))
    order = np.lexsort((band, n))[::-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(np.append(True, np.diff(band[order]) != 0)[: len(order)]) - 1
    return np.split(place, np.cumsum(pc.list_value_length(bands).to_numpy())[:-1]), band, place


def _may_reach(texts: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs may be similar by their sizes: of two texts without repeats the shorter must have enough shingles."""
    distinct = np.array([len(np.unique(t)) for t in texts], float)
    plain = distinct == np.array([len(t) for t in texts])
    enough = np.minimum.outer(distinct, distinct) >= threshold * np.maximum.outer(distinct, distinct) - 1e-9
    return enough | ~(plain[:, None] & plain[None, :])


def _compare(threshold: float):
    def compare(block: pa.Table) -> pa.Table:
        names, root = np.unique(np.array(block.column("root").to_pylist(), object), return_inverse=True)
        out: list[tuple[bytes, bytes]] = []
        if len(names) > 1:
            bands, band, place = by_size(block.column("bands").combine_chunks())
            own = place[np.flatnonzero(band == block.column("band")[0].as_py())[0]]
            apart = np.triu(root[:, None] != root[None, :], 1) & meet_first(bands, own)
            if apart.any():
                texts = [np.frombuffer(x, "<u4") for x in block.column("shingles").to_pylist()]
                apart &= _may_reach(texts, threshold)
                # Few pairs are compared one by one, many all at once.
                sure = np.zeros_like(apart)
                if apart.sum() * 16 > len(texts) ** 2:
                    links, maybe = similar_in_block(texts, threshold)
                    sure, apart = links & apart, (links | maybe) & apart
                # Of the links between classes, what joins them up.
                leader = np.arange(len(names))
                for i, j in [*np.argwhere(sure), *np.argwhere(apart & ~sure)]:
                    x, y = leader[root[i]], leader[root[j]]
                    if x != y and (sure[i, j] or similarity(texts[i], texts[j]) >= threshold):
                        leader[leader == max(x, y)] = min(x, y)
                        out.append((names[root[i]], names[root[j]]))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"ra": pa.array(a, pa.binary()), "rb": pa.array(b, pa.binary())})

    return compare


def _joined_up(found: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) after the classes' roots are linked in turn; classes of one node may be among them."""
    step = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    moved = found.join(step, F.col("root") == F.col("_node"), "left").select("node", F.coalesce("_root", "root").alias("root"))
    return moved.unionByName(roots.join(found.select("node"), "node", "left_anti"))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, row, class_id, class_row, class_size) for every row of ``docs``; ``row`` is its ``row_key`` of id and text."""
    spark = docs.sparkSession
    read = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    signed, signed_at = staged(read.mapInArrow(_signer(bands, rows), SIGNED), "signed")
    named, _ = staged(signed.select("doc_id", "row", "node"), "nodes")
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"))
    shared = nodes.select("node", F.explode("bands").alias("band"))
    crowded = shared.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    banded, banded_at = staged(shared.join(crowded, "band"), "bands")
    payload, payload_at = staged(
        signed.select("node", "shingles").join(banded.select("node").distinct(), "node").groupBy("node").agg(F.first("shingles").alias("shingles")), "shingles"
    )
    # Shingles of texts that share no band are done with.
    discard(spark, signed_at)
    pairs = _candidates(banded.withColumn("root", F.col("node")))
    with_a = pairs.join(payload.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    with_both = with_a.join(payload.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b").select("ra", "rb", "sa", "sb")
    links, links_at = staged(with_both.mapInArrow(_verify(threshold), "ra binary, rb binary"), "verified")
    found = components(links.toDF("a", "b"))
    discard(spark, links_at)
    # Classes so far are the nodes now: what is linked stays linked, and the graph gets smaller.
    opened, opened_at = staged(_several(_renamed(banded.withColumn("root", F.col("node")), found)), "open-bands")
    discard(spark, banded_at)
    carried = _sized(opened).groupBy("node").agg(F.collect_set(F.struct("n", "band")).alias("bands")).join(payload, "node")
    # A stated number of partitions: blocks are costly for their bytes, so small ones aren't put together.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = _blocks(opened).join(carried, "node").repartition(parts, "band", "i", "j")
    links, links_at = staged(met.groupBy("band", "i", "j").applyInArrow(_compare(threshold), "ra binary, rb binary"), "verified")
    discard(spark, payload_at)
    discard(spark, opened_at)
    found = _joined_up(found, components(links.toDF("a", "b")))
    discard(spark, links_at)
    classed = named.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))).alias("first")
    sizes = classed.groupBy("root").agg(first, F.count("*").alias("class_size"))
    sizes = sizes.select("root", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("class_row"), "class_size")
    return classed.join(sizes, "root").select("doc_id", "row", "class_id", "class_row", "class_size")


def op10_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each near-duplicate class the document with the least doc_id stays."""
    keep = (F.col("row") == F.col("class_row")).cast("bigint")
    return apply_copies(docs, near_classes(docs).groupBy("doc_id", "row").agg(F.max(keep).alias("copies"), F.count("*").alias("times")))
