"""Connected components by label propagation with pointer jumping, on stored tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatekit.llm.common import stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of the undirected edges (a, b); label is the smallest
    node that it reaches.

    A round gives each node the smallest label around it, then the label of that label.
    Star-shaped and random graphs settle in a few rounds, paths in about the logarithm
    of their length. A hub's edges meet in joins only, which adaptive execution splits,
    and in a minimum, which is taken before the shuffle.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    state = stored(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while True:
        around = (both.join(state.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("__least")))
        near = state.join(around, "node", "left").select("node", F.col("label").alias("__old"), F.least("label", "__least").alias("__to"))
        near = stored(near, "labels")
        jump = near.select(F.col("node").alias("__to"), F.col("__to").alias("label"))
        new = stored(near.join(jump, "__to").select("node", "label", "__old"), "labels")
        state = new.select("node", "label")
        if new.filter("label <> __old").isEmpty():
            return state
