"""Connected components by minimum labels and pointer jumping.

Nodes are pairs of longs (128-bit ids). Every round takes the smallest label
among each node's neighbours (a map-side combined minimum) and then follows
each label once, so paths halve. Rounds are written to the shared folder,
which cuts the lineage. The join with a node of very many links is split by
Spark's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stored


def node(prefix: str):
    return F.struct(F.col(f"{prefix}1").alias("n1"), F.col(f"{prefix}2").alias("n2"))


def components(edges: DataFrame) -> DataFrame:
    """``n1, n2, c1, c2``: each linked node and its component's smallest node.

    ``edges``: columns a1, a2, b1, b2 (longs, not null), in any direction;
    repeated edges and self-loops do no harm.
    """
    both = edges.select("a1", "a2", "b1", "b2").union(
        edges.select(F.col("b1").alias("a1"), F.col("b2").alias("a2"),
                     F.col("a1").alias("b1"), F.col("a2").alias("b2")))
    both = stored(both.distinct(), "edges")
    least = F.min(node("b")).alias("least")
    labels = both.groupBy("a1", "a2").agg(least).select(
        F.col("a1").alias("n1"), F.col("a2").alias("n2"),
        F.least(F.struct(F.col("a1").alias("n1"), F.col("a2").alias("n2")), "least").alias("c"))
    labels = stored(labels, "labels")
    while True:
        at = labels.select(F.col("n1").alias("b1"), F.col("n2").alias("b2"), F.col("c").alias("l"))
        near = both.join(at, ["b1", "b2"]).groupBy(
            F.col("a1").alias("n1"), F.col("a2").alias("n2")).agg(F.min("l").alias("near"))
        lower = labels.join(near, ["n1", "n2"]).select("n1", "n2", F.col("c").alias("old"),
                                                      F.least("c", "near").alias("c"))
        up = labels.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("c").alias("pc"))
        jumped = lower.join(up, (F.col("c.n1") == F.col("p1")) & (F.col("c.n2") == F.col("p2"))
                            ).select("n1", "n2", "old", F.least("c", "pc").alias("c"))
        jumped = stored(jumped, "labels")
        if jumped.where(F.col("old") != F.col("c")).isEmpty():
            return jumped.select("n1", "n2", F.col("c.n1").alias("c1"), F.col("c.n2").alias("c2"))
        labels = jumped.drop("old")
