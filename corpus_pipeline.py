"""From raw documents to packed training sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconfold.llm.best_fit_packing import packing_stage
from beaconfold.llm.common import staged
from beaconfold.llm.exact_dedup import exact_stage
from beaconfold.llm.line_cleaning import quality_stage
from beaconfold.llm.prob_minhash import near_stage
from beaconfold.llm.source_mixing import mixing_stage

STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Near duplicates, tokens and packing can't be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; between stages, documents are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
