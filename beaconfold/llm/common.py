"""What the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconfold.sources.scratch import remove_dir, shared_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_text(column: str = "text") -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(*columns: Column) -> Column:
    """A 64-bit key from a row's content: equal rows share it, on every run and executor."""
    return F.xxhash64(*columns)


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written to the shared folder and read again, and its place: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing will read any more."""
    remove_dir(spark, path)


def carried(docs: DataFrame, *without: str) -> Column:
    """A row's columns as one struct, beside which own columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without])


def apply_copies(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents as often as ``verdicts`` say: (doc_id, row, copies: how many to give out, times: how many there are).

    ``row`` is the ``row_key`` of id and text. Rows are found by both, so a key counts among the rows of one id only. Of rows
    equal in both, one is taken and given out ``copies`` times; partial aggregation finds it, however often it occurs.
    """
    named = verdicts.where("copies > 0").select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "copies", "times")
    rows = docs.select(carried(docs).alias("doc"), F.col("doc_id").alias("id"), row_key(F.col("doc_id"), F.col("text")).alias("key"))
    joined = rows.join(named, (F.col("key") == F.col("of_row")) & F.col("id").eqNullSafe(F.col("of_id")))
    given = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies").cast("bigint"))).alias("copy")
    single = joined.where("times = 1").select("doc", given)
    first = joined.where("times > 1").groupBy("key", "id", "copies").agg(F.min_by("doc", F.xxhash64("doc")).alias("doc"))
    return single.unionByName(first.select("doc", given)).select("doc.*")
