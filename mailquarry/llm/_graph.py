"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailquarry.llm._runtime import stage


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, component): for every end of an edge the smallest id that edges reach from it.

    Rounds of two joins: each id takes the smallest label among its neighbours and itself, then the label
    of that label. Labels only fall, so this ends when no label changes, after about the
    logarithm of the longest path. Each round is staged. Hubs are keys of plain joins, which Spark
    splits if they are skewed, and of sums that are combined before the shuffle.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    both = stage(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("label").alias("further"))
        lower = lower.join(jump, "next").select("id", F.least("next", "further").alias("fresh"), "label")
        lower = stage(lower, "labels")
        changed = lower.where("fresh < label").limit(1).count()
        labels = lower.select("id", F.col("fresh").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
