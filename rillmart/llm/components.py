"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the smallest node of the component.

    Each round gives a node the smallest label among its neighbours and then the label
    of that label, so the distance to the smallest node at least halves.  Rounds go on
    until no label changes; each writes its labels to the shared folder.
    """
    links = links.select("a", "b")
    both = stored(links.union(links.select("b", "a")).distinct().toDF("node", "other"), "links")
    labels = stored(both.groupBy("node").agg(F.min("other").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # The label is a node itself: go on to its own label.
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        after = stored(lower.join(ahead, "label").select("node", "old", F.least("label", "ahead").alias("label")), "labels")
        changed = after.filter(F.col("old") != F.col("label")).limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
