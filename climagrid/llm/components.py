"""Connected components by smallest labels, with the state of each round in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climagrid.sources.scratch import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (``a, b``): the smallest node it is linked with.

    Each round takes the smallest label among a node's neighbours and then that label's own label,
    so distances halve. Tables of a row per node are joined, never a component's members collected.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = materialize(both, "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
    labels = materialize(labels.select("node", F.least("node", "comp").alias("comp")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.least("comp", "near").alias("hook"), F.col("comp").alias("old")
        )
        hooked = materialize(hooked, "hooked-labels")
        parents = hooked.select(F.col("node").alias("parent"), F.col("hook").alias("above"))
        jumped = hooked.join(parents, hooked["hook"] == parents["parent"], "left").select(
            "node", F.least("hook", F.coalesce("above", "hook")).alias("comp"), "old"
        )
        jumped = materialize(jumped, "labels")
        if jumped.where("comp <> old").isEmpty():
            return jumped.select("node", "comp")
        labels = jumped.select("node", "comp")
