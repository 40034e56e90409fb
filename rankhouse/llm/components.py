"""Connected components of a table of links, without bringing links or components to one task or the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankhouse.llm.common import Stages


def components(links: DataFrame) -> DataFrame:
    """(node, root) for links (a, b) of longs: root is the smallest node that is reachable. Every round takes the smallest label
    among a node and its neighbours and then the label of that label, so rounds grow with the logarithm of the longest
    way; each round's labels are a written table. Minima over neighbours are partial aggregates, so a hub does no harm."""
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))  # the links are computed once
    kept = Stages()
    both = kept.write(links.where("a <> b").select(F.explode(ways).alias("way")).select("way.*").distinct(), "links")
    old = Stages()
    labels = old.write(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("before"), F.least("root", "near").alias("root"))
        lower = old.write(lower, "labels")
        ways = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = lower.join(ways, "root").select("node", "before", F.least("root", "far").alias("root"))
        new = Stages()
        jumped = new.write(jumped, "labels")
        old.drop()
        labels, old = jumped.select("node", "root"), new
        if jumped.where("root <> before").isEmpty():
            kept.drop()
            return labels
