"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links(a, b)``: the label is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of the longest path. A node's neighbours are reduced
    before the shuffle; each round's labels are written to the shared folder.
    """
    links = links.filter("a <> b")
    both = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a")).agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, labels["node"] == near["a"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        stepped = materialize(stepped)
        further = stepped.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        nxt = materialize(
            stepped.join(further, F.col("label") == F.col("via"), "left").select(
                "node", "old", F.least("label", "beyond").alias("label")
            )
        )
        labels = nxt.select("node", "label")
        if nxt.filter("old <> label").isEmpty():
            return labels
