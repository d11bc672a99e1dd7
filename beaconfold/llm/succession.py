"""Each document with the one that follows it, in one shuffle of the texts.

Documents are ordered by descending doc_id, nulls last, then by hashes of the text; the first follows the last. The order is a
text key. Cut keys, taken from a bounded sample of the keys so that parts hold about equally many bytes, divide it into parts; as a cut key is the key of a real
row, the first row of each part is known before the shuffle, and a copy of it is sent along to end the part before. So each
part is complete in itself, whatever executor holds it, and nothing passes one task or the driver but the sample.

Rows equal in id and text follow each other. If there are any, they are collapsed first, with partial aggregation,
so that a third of all rows being one is no burden to a task: all but the last of them are followed by their own text.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconfold.llm.common import plain_text

#: Bytes of text a part is meant to hold; at most so many parts, and sampled keys for each of them.
PART_BYTES = 16 << 20
MAX_PARTS = 32_768
SAMPLED = 16


def order_key(doc_id: Column, text: Column) -> Column:
    """Text whose ascending order is that of descending doc_id, nulls last, then of the text's hashes."""
    falling = F.bitwise_not(doc_id).bitwiseXOR(F.lit(-(1 << 63)))
    number = F.coalesce(F.lpad(F.hex(falling), 16, "0"), F.lit("~"))
    return F.concat(number, F.lit("."), F.lpad(F.hex(F.xxhash64(text)), 16, "0"), F.lpad(F.hex(F.hash(text)), 8, "0"))


def _cuts(keys: DataFrame, first: str, rows: int, size: int) -> list[str]:
    """The first keys of all parts: that of all, and others so that parts hold about equally many bytes."""
    parts = min(MAX_PARTS, -(-size // PART_BYTES))
    if parts < 2:
        return [first]
    one_in = max(1, rows // (parts * SAMPLED))
    sample = keys.where(F.pmod(F.xxhash64("key"), F.lit(one_in)) == 0).orderBy("key").collect()
    filled = np.cumsum([r["size"] for r in sample])
    at = np.unique(np.searchsorted(filled, np.arange(1, parts) * (filled[-1] / parts))) if len(sample) else []
    return sorted({first, *(sample[min(int(k), len(sample) - 1)]["key"] for k in at)})


def _parts(cuts: Sequence[str]):
    starts = np.array(cuts, "S48")

    def find(keys: pd.Series) -> pd.Series:
        own = keys.to_numpy().astype("S48")
        part = np.searchsorted(starts, own, "right") - 1
        is_first = starts[part] == own
        before = (part - 1) % len(starts)
        return pd.Series([[int(p), int(b)] if f else [int(p)] for p, b, f in zip(part, before, is_first, strict=True)])

    return F.pandas_udf(find, T.ArrayType(T.IntegerType()))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (part, last, key, doc_id, text, times), the parts of a task one after another, each in order.

    What follows a row is the next row of its part, down to one with ``last``, which only serves to follow. A row with
    ``times`` stands for so many equal ones.
    """
    docs = docs.select("doc_id", plain_text().alias("text"))
    key = order_key(F.col("doc_id"), F.col("text")).alias("key")
    sized = docs.select(key, F.octet_length("text").alias("size"))
    total = sized.groupBy("key").agg(F.count("*").alias("times"), F.max("size").alias("size")).agg(
        F.min("key").alias("first"), F.count("*").alias("keys"), F.sum(F.col("size").cast("bigint")).alias("size"), F.max("times").alias("times")
    ).first()
    if total["times"] is not None and total["times"] > 1:
        docs = docs.groupBy("doc_id", "text").agg(F.count("*").alias("times"))
    else:
        docs = docs.withColumn("times", F.lit(1).cast("bigint"))
    if total["first"] is None:
        return docs.select(F.lit(0).alias("part"), F.lit(False).alias("last"), key, "doc_id", "text", "times")
    cuts = _cuts(sized, total["first"], total["keys"], total["size"])
    placed = docs.select(key, "*").withColumn("parts", _parts(cuts)("key"))
    each = placed.select(F.posexplode("parts").alias("_at", "part"), "key", "doc_id", "text", "times")
    rows = each.select("part", (F.col("_at") > 0).alias("last"), "key", "doc_id", "text", "times")
    return rows.repartition("part").sortWithinPartitions("part", "last", "key")
