"""Connected components of a graph given as rows, in rounds that never gather a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, label): label is the least node reachable. Loops and repeated edges do no harm; null ends are left out.

    Large-star and small-star rounds alternate: every node hands its larger neighbours to its least
    neighbour, then its smaller ones. Only a node's least neighbour is aggregated, so a hot node costs
    one row a task before the shuffle; joins on hot nodes are left to the skew handling of adaptive
    execution. Each round is written to the shared folder. The edges end as stars around the labels.
    """
    e = checkpointed(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct())
    for _ in range(most_rounds):
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        # u has its smaller neighbours v only; its least neighbour takes them all (small star).
        small = e.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        both = small.unionByName(small.select(F.col("v").alias("u"), F.col("u").alias("v")))
        root = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Every neighbour larger than u goes to the least of u and its neighbours (large star).
        large = both.where("v > u").join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = checkpointed(large)
        # Done when each node stands under one label and no label stands under another.
        over = e.groupBy("u").count().where("count > 1").select("u").unionByName(e.select(F.col("v").alias("u")).join(e.select("u"), "u", "left_semi"))
        if over.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
