"""URL filter: host and path rules, then the ratio of two character language models.

Rules decide what they fit. The URLs that rules accept and reject train two variable-order Markov models over
characters, smoothed by interpolation: after a context seen n times with t different followers, a character has
(count + t * probability after the context one shorter) / (n + t), down to a uniform 1 / ``ALPHABET``. A URL's score is
the difference of the models' log-likelihoods a character. One in ``FOLDS`` of the labelled URLs is held out of the counts, and
the threshold is the score that separates those best (mean of both classes' hit rates; the one nearest 0 of equals).

N-grams are counted exactly over all labelled URLs in Spark, and scores are taken from those counts as they are: rows make parts
of bounded size, each part asks once for the distinct contexts and n-grams of its URLs, and the counts are joined and brought
back to it. So no task holds a model, and what is moved grows with the input, an n-gram in all URLs being one row a part.
N-grams are told apart by 64-bit hashes.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is scored as it stands (null as
empty); an empty text scores 0; without labelled URLs of both kinds every score and the threshold are 0; a
score equal to the threshold is allowed. Other columns stay in ``judge_urls``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.llm.common import staged, table
from beaconfold.llm.hashing import mix, text_bytes

#: Fixed rules (host and path, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDER = 5
ALPHABET = 256
FOLDS = 5
BINS = 4000
SPAN = 10.0
#: N-grams a task holds before it hands its counts on.
FLUSH = 200_000
#: Rows of a part are at most two to this power.
PART_BITS = 14


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        site, _, folder = rule.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit("/" + folder))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(data: np.ndarray, bounds: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order: the hashes of every character's context and of context and character, a start mark before each text."""
    n = len(data)
    place = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    context = np.full(n, 7, np.uint64)
    values = data.astype(np.uint64)
    for k in range(order):
        if k:
            back = np.zeros(n, np.uint64)
            back[k:] = values[: n - k] + np.uint64(1)
            back[place < k] = 0  # before the text's start
            context = mix(context + back * np.uint64(2 * k + 1))
        yield k, context, mix(context ^ (values + np.uint64(0x51ED270B)) * np.uint64(0x9E3779B97F4A7C15))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        rows = [[*key, n] for key, n in counts.items()]
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.bool_()), pa.array(cols[1], pa.int32()), pa.array(np.array(cols[2], np.uint64).view(np.int64)), pa.array(np.array(cols[3], np.uint64).view(np.int64)), pa.array(cols[4], pa.int64())],
            ["good", "k", "context", "gram", "n"],
        )

    for batch in batches:
        data, bounds = text_bytes(batch.column("scored"))
        good = np.repeat(batch.column("good").to_numpy(zero_copy_only=False), np.diff(bounds))
        for k, context, gram in _grams(data, bounds, ORDER):
            for label in (True, False):
                of = good == label
                pairs, n = np.unique(np.stack([context[of], gram[of]], axis=1), axis=0, return_counts=True)
                for (c, g), m in zip(pairs.tolist(), n.tolist(), strict=True):
                    counts[(label, k, c, g)] += m
        if len(counts) > FLUSH:
            yield out()
            counts.clear()
    if counts:
        yield out()


def train(labelled: DataFrame) -> DataFrame:
    """``labelled``: scored (text), good. (key, good_n, good_kinds, bad_n, bad_kinds) of every context and n-gram; an n-gram has no kinds."""
    counted = labelled.mapInArrow(_count, "good boolean, k int, context bigint, gram bigint, n bigint")
    grams, _ = staged(counted.groupBy("good", "k", "context", "gram").agg(F.sum("n").alias("n")), "grams")

    def facts(key: str, kinds: int) -> DataFrame:
        def of(good: bool, count: Column) -> Column:
            return F.sum(F.when(F.col("good") == good, count).otherwise(0))

        n, one = F.col("n"), F.lit(kinds)
        sums = [of(True, n).alias("good_n"), of(True, one).alias("good_kinds"), of(False, n).alias("bad_n"), of(False, one).alias("bad_kinds")]
        return grams.groupBy(F.col(key).alias("key")).agg(*sums)

    return facts("context", 1).unionByName(facts("gram", 0))


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, key): the contexts and n-grams of each part's texts, once for each batch."""
    for batch in batches:
        data, bounds = text_bytes(batch.column("scored"))
        part = batch.column("part").to_numpy()
        at = np.repeat(part, np.diff(bounds))
        keys = [(context, gram) for _, context, gram in _grams(data, bounds, ORDER)]
        for one in np.unique(part):
            of = at == one
            asked = np.unique(np.concatenate([x[of] for pair in keys for x in pair]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(asked), one)), pa.array(asked.view(np.int64))], ["part", "key"])


def _scores(data: np.ndarray, bounds: np.ndarray, keys: np.ndarray, counts: list[list[np.ndarray]]) -> np.ndarray:
    """Each text's log-likelihood difference a byte. ``keys`` are sorted; ``counts`` has for each model, bad and good, how often
    each key occurs and how many followers it has."""
    p = [np.full(len(data), 1.0 / ALPHABET), np.full(len(data), 1.0 / ALPHABET)]

    def places(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    for _, context, gram in _grams(data, bounds, ORDER) if len(keys) else ():
        (c, has_c), (g, has_g) = places(context), places(gram)
        for m, (times, kinds) in enumerate(counts):
            n, t = times[c] * has_c, kinds[c] * has_c
            p[m] = np.where(n > 0, (times[g] * has_g + t * p[m]) / np.maximum(n + t, 1), p[m])
    sums = np.concatenate([[0.0], np.cumsum(np.log(p[1]) - np.log(p[0]))])
    return (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(1, np.diff(bounds))


def _score_part(rows: pa.Table, facts: pa.Table) -> pa.Table:
    key = facts.column("key").to_numpy().view(np.uint64)
    keys, first = np.unique(key, return_index=True)
    counts = [[facts.column(f"{m}_{c}").to_numpy()[first].astype(np.float64) for c in ("n", "kinds")] for m in ("bad", "good")]
    scores = _scores(*text_bytes(rows.column("scored").combine_chunks()), keys, counts)
    return rows.append_column("score", pa.array(scores, pa.float64()))


def score_urls(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows`` (scored, part and any others) with score."""
    asked = rows.select("scored", "part").mapInArrow(_ask, "part bigint, key bigint").distinct()
    known = asked.join(facts, "key")
    fields = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    return rows.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(_score_part, fields)


def calibrate(scored: DataFrame) -> float:
    """The threshold that best separates ``scored`` (score, good), from a histogram of fixed bins."""
    at = F.floor((F.greatest(F.least("score", F.lit(SPAN)), F.lit(-SPAN)) + SPAN) * (BINS / (2 * SPAN))).cast("int")
    counts = scored.groupBy(at.alias("bin"), "good").count().toPandas()
    bins = np.zeros((2, BINS + 1))
    bins[counts["good"].astype(int), counts["bin"]] = counts["count"]
    if not bins.sum(axis=1).all():
        return 0.0
    # Threshold at the lower edge of bin b: rejected ones below it, accepted ones from it on.
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(bins, axis=1)], axis=1) / bins.sum(axis=1, keepdims=True)
    gain = below[0] + 1 - below[1]
    edges = np.arange(BINS + 2) * (2 * SPAN / BINS) - SPAN
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` (url and any others) with host, path, rule, score and verdict."""
    host, path = host_and_path(F.col("url"))
    at = F.instr(F.col("url"), "://")
    scored = F.coalesce(F.when(at > 0, F.substr(F.col("url"), at + 3)).otherwise(F.col("url")), F.lit(""))
    ruled = pages.withColumns({"host": host, "path": path}).withColumn("_ruled", fitting_rule(F.col("host"), F.col("path"), rules))
    fold = F.pmod(F.xxhash64(F.lit(11), "url"), F.lit(FOLDS))
    # Written, so that a row's part is the same whenever it is read.
    part = F.shiftright(F.monotonically_increasing_id(), PART_BITS)
    every, _ = staged(ruled.withColumns({"scored": scored, "fold": fold, "part": part}), "urls")
    good = (F.col("_ruled.verdict") == "allow").alias("good")
    labelled = every.where("_ruled.verdict IS NOT NULL")
    judged, _ = staged(score_urls(every, train(labelled.where("fold > 0").select("scored", good))), "scored")
    threshold = calibrate(judged.where("_ruled.verdict IS NOT NULL AND fold = 0").select("score", good))
    method = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return judged.select(*pages.columns, "host", "path", F.col("_ruled.rule").alias("rule"), "score", F.coalesce("_ruled.verdict", method).alias("verdict"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
