"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm.common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of the edges (u, v): comp is the smallest node that it reaches.

    Each round takes the smallest label among the neighbours, then the label of that label, so a path of n nodes needs
    a number of rounds in the order of log n.  Sums are combined before every shuffle, so a node with very many
    neighbours costs each task one row.  Labels are written and read again after each round.
    """
    both = cut(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct(), "edges")
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("u"), F.min("v")).alias("comp")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("v"), "comp"), "v").groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = cut(lower.join(jump, "comp", "left").select("node", "was", F.least("comp", F.coalesce("up", "comp")).alias("comp")), "labels")
        labels = new.select("node", "comp")
        if new.where("comp <> was").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
