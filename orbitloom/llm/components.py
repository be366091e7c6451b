"""Connected components by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitloom.llm.common import stored


def components(edges: DataFrame, most: int = 50) -> DataFrame:
    """(node, component) of the nodes in edges (a, b); component is the least node reachable. Edges may repeat, run either way or lead to themselves; rows with a null don't count.

    In a round each node takes the least label among its neighbours', then the label that label's node has; stars end in two rounds and chains in about the logarithm of their length.
    """
    edges = edges.filter("a is not null and b is not null")
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")), "components")
    for _ in range(most):
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m"))
        least = labels.join(near, labels["node"] == near["a"]).select("node", "component", F.least("component", "m").alias("m"))
        jump = labels.select(F.col("node").alias("m"), F.col("component").alias("next"))
        new = stored(least.join(jump, "m").select("node", "component", F.least("m", "next").alias("next")), "components")
        labels = new.select("node", F.col("next").alias("component"))
        if new.filter("component <> next").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most} rounds")
