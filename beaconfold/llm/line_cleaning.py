"""Line-first cleaning: rules on each line, failing lines removed, documents that lose too much text rejected.

Column expressions only. A line is what stands between line feeds; a line without a word is left alone. It fails if

* punctuation: it has at least ``min_line_words`` words and no sentence end (``.!?:;`` or an ellipsis, quotes or brackets after
  it allowed) in its last word nor anywhere else in more than one word of ``words_a_stop``;
* navigation: separator words (``| > / » • - *`` alone) are ``separator_share`` of its words or more, at least two of them;
* boilerplate: phrases of ``BOILERPLATE`` (lower case) are ``phrase_share`` of its words or more, or it holds symbols ``#*$%&|<>``
  at a rate of ``symbol_share`` a word. So a paragraph, or a whole text on one line, isn't lost for a phrase it mentions.

A document is rejected if its words' code points fall below ``keep_share`` of what they were, or if it fails the base
rules on the whole text (under 10 words; over 20 % of its words in repeated five-word windows). Null text counts as
empty and is rejected; equal rows get equal verdicts; other columns stay.

Five-word windows are compared by a 64-bit hash of the words: within one text, a chance equality is under 1e-9 for a
million words.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.llm.common import SPACE, carried, plain_text, table

#: Fixed phrases that mark a line as boilerplate.
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "use cookies",
    "javascript is disabled", "enable javascript", "lorem ipsum", "skip to content", "click here to subscribe",
)
STOP = r"[.!?:;…。][\"'’”»)\]]*"
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def windows_of(words: Column) -> Column:
    """Hashes of the five-word windows, in order; none if there is but one window. ``words`` is a plain column."""
    n = F.size(words)
    starts = F.slice(words, F.lit(1), F.greatest(n - 4, F.lit(0)))
    hashes = F.transform(starts, lambda _, i: F.xxhash64(*[F.get(words, i + k) for k in range(5)]))
    return F.when(n > 5, hashes).otherwise(F.array().cast("array<bigint>"))


def covered(windows: Column) -> Column:
    """How many words the windows cover that share their hash with another; ``windows`` is a plain column of hashes."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(of: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            before, after = F.get(of, j - 1), F.get(of, j + 1)
            return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(of, same), lambda x: x["i"]))

    # let-binding by a one-element array: the sorted array is computed once
    places = F.flatten(F.transform(F.array(placed), repeated))
    total = F.transform(
        F.array(places),
        lambda p: F.aggregate(
            p,
            F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n")),
            lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(5), i - s["last"])).alias("n")),
            lambda s: s["n"],
        ),
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(total[0])


def line_fails(
    line: Column, min_line_words: int = 6, words_a_stop: int = 40, separator_share: float = 0.3, symbol_share: float = 0.5,
    phrase_share: float = 0.2,
) -> Column:
    """Whether a line fails one of the line rules."""
    # Inside a lambda nothing is computed once for several uses: what decides most lines comes first, word counts last.
    n = F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+"))
    stops = F.regexp_count(line, F.lit(STOP + r"(?=[\x20\x09-\x0D]|$)"))
    separators = F.regexp_count(line, F.lit(r"(?<![^\x20\x09-\x0D])[|>/»•*-](?![^\x20\x09-\x0D])"))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))

    def phrase_words(low: Column) -> Column:
        """How many words of the line stand in phrases."""
        return reduce(add, [(F.length(low) - F.length(F.replace(low, F.lit(p), F.lit("")))) / len(p) * len(p.split()) for p in BOILERPLATE])

    def is_phrases(low: Column) -> Column:
        # Most lines hold no phrase, and the words aren't counted then.
        return reduce(or_, [F.contains(low, F.lit(p)) for p in BOILERPLATE]) & (phrase_words(low) >= n * phrase_share)

    phrase = F.exists(F.array(F.lower(line)), is_phrases)
    ends = F.regexp_like(line, F.lit(STOP + r"[\x20\x09-\x0D]*$"))
    no_punctuation = ~ends & (n >= min_line_words) & (stops * words_a_stop < n)
    navigation = (separators >= 2) & (separators >= n * separator_share)
    boilerplate = phrase | ((symbols >= 1) & (symbols >= n * symbol_share))
    return F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")) & (no_punctuation | navigation | boilerplate)


def _computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once. Through a plain projection the optimizer would copy their expressions to each
    place of use, filters included; it doesn't move anything past a generator."""
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.withColumn("_once", F.explode(F.array(row))).withColumns({n: F.col("_once")[n] for n in columns}).drop("_once")


def clean_lines(docs: DataFrame, keep_share: float = 0.5, **rules: float) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text and kept."""
    text = F.col("_text")
    parts = _computed(
        docs.withColumn("_text", plain_text()),
        {
            "_words": words_of(text),
            "_lines": F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))),
            "clean_text": F.array_join(F.filter(F.split(text, "\n"), lambda x: ~line_fails(x, **rules)), "\n"),
        },
    )
    parts = _computed(parts, {"_windows": windows_of(F.col("_words"))})
    counted = _computed(
        parts,
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": covered(F.col("_windows")).cast("bigint"),
            "_left": F.length(F.regexp_replace("clean_text", SPACE + "+", "")),
        },
    )
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~base_failed & (F.col("_left") >= keep_share * F.col("word_chars"))
    return counted.withColumns({"base_failed": base_failed, "kept": kept}).drop("_text", "_words", "_lines", "_windows", "_left")


def op6_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return clean_lines(table(spark, sf_dir, "documents")).select("doc_id", *base, "base_failed", "kept")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, failing lines leave the others' texts."""
    cleaned = clean_lines(docs.select(carried(docs, "text").alias("doc"), "text")).where("kept")
    own = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast(docs.schema["n_chars"].dataType)}
    return cleaned.select(*[own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
