"""Connected components of a link table, as Spark joins.

Every node starts with the smallest id among itself and its neighbours;
each round takes the smallest label over all links (partial aggregation, so
a hub costs one row per task) and then follows labels of labels, until
nothing changes.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.llm.kernels import stash


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; ``component`` is
    the smallest reachable node.  Self links and repeated links are fine."""
    both = stash(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                 .union(links.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "links")
    labels = stash(both.groupBy(F.col("u").alias("node"))
                   .agg(F.least(F.col("node"), F.min("v")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both.v == labels.node).groupBy("u")
                .agg(F.min("component").alias("near")))
        step = (labels.join(near, labels.node == near.u)
                .select("node", F.col("component").alias("old"),
                        F.least("component", "near").alias("component")))
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("top"))
        step = stash(step.join(up, step.component == up.up, "left")
                     .select("node", "old", F.least("component", "top").alias("component")), "labels")
        labels = step.select("node", "component")
        if step.filter("old <> component").isEmpty():
            return labels
