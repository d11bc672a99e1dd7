"""Connected components of a link table, by least neighbours and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconfold.llm.common import discard, staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node of its component.

    In each round a node takes the least root of its neighbours, and then that root's own root, so the number of rounds
    grows with the logarithm of the longest chain; it ends when a round changes nothing. Minima are found by
    partial aggregation, so a node with any number of neighbours is no burden. Every round is written to the shared
    folder, and so is what is returned; ``links`` is read in each round: give a stored table. Loops (a = b), repeated
    links and an empty table are fine.
    """
    spark = links.sparkSession
    both = links.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
    both = both.select("e.a", "e.b")
    state, path = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        near = both.join(state, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        lower = state.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "near").alias("near"))
        jump = state.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        jumped = lower.join(jump, F.col("near") == F.col("_node")).select("node", F.col("_root").alias("root"), (F.col("_root") < F.col("root")).alias("moved"))
        new, new_path = staged(jumped, "roots")
        moved = new.where("moved").isEmpty()
        discard(spark, path)
        state, path = new.drop("moved"), new_path
        if moved:
            return state
