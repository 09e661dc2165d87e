"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.sources.tables import cut


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the least node of each node's component.

    nodes: (node); links: (a, b), taken in both directions. Each round every node takes the
    least label among its neighbours' and then that label's own label, which halves paths;
    rounds end when no label changes. Labels are cut to the shared checkpoint folder every
    round; nothing is gathered. Null nodes are left out; loops and repeated links do no harm.
    """
    ends = links.where("a is not null and b is not null and a <> b")
    both = cut(ends.select("a", "b").union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = nodes.where("node is not null").select("node").distinct().withColumn("component", F.col("node"))
    while True:  # labels only fall, so this ends
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("heard"))
        told = labels.join(heard, labels["node"] == heard["a"], "left").select("node", "component", F.least("component", F.coalesce("heard", "component")).alias("new"))
        up = told.select(F.col("node").alias("new"), F.col("new").alias("root"))
        jumped = told.join(up, "new", "left").select("node", F.col("component").alias("old"), F.least("new", F.coalesce("root", "new")).alias("component"))
        jumped = cut(jumped)
        changed = jumped.where("old <> component").limit(1).count()
        labels = jumped.select("node", "component")
        if not changed:
            return labels
