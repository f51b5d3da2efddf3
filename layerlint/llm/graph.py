"""Connected components of links between 64-bit keys, as a few joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layerlint.session import written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """One row (node, component) per key in ``links`` (a, b); component is the smallest key that links reach.

    Every round each key takes the smallest label among its neighbours and then the label of that label, so the number of
    rounds grows with the logarithm of the longest path. Each round is stored in the shared folder: a lost executor costs
    only its part of one round. Links of a key to itself give a component of one. ``links`` should be a stored table, as
    every round reads it; a link may come twice or from both ends.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("new"))
        up = labels.select(F.col("node").alias("new"), F.col("label").alias("up"))
        after = written(moved.join(up, "new").select("node", F.col("label").alias("old"), F.least("new", "up").alias("label")), name)
        labels = after.select("node", "label")
        if after.filter(F.col("old") != F.col("label")).isEmpty():
            return labels.withColumnRenamed("label", "component")
