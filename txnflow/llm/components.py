"""Connected components of links, by hooking to the smallest neighbour and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every end of the links (a, b); label is the smallest node reachable.

    Every node hooks to the smallest of its neighbours and itself, which gives trees with their smallest node as root;
    pointers jump until each node knows its root, as many steps as the depth has binary digits.  The roots are the
    nodes of the next round, with the links between their trees.  A root that nobody hooked to has a neighbour whose
    tree has a smaller root, so it hooks in the round after: the nodes left halve at least in every two rounds.

    Tables of a step are written.  The neighbours of a node with many links are combined before the shuffle, and its
    links are joined with a table of one row per node, which Spark can split.
    """
    links = links.filter("a <> b").select("a", "b")
    edges = stored(links.union(links.select("b", "a")).distinct(), "links")
    labels = None
    while True:
        up = edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("up"))
        up = stored(up.withColumn("moved", F.lit(True)), "trees")
        while not up.filter("moved").isEmpty():
            above = up.select(F.col("node").alias("up"), F.col("up").alias("next"))
            up = up.join(above, "up").select("node", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved"))
            up = stored(up, "trees")
        up = up.drop("moved")
        if labels is None:
            labels = up.withColumnRenamed("up", "label")
        else:
            new = labels.join(up.withColumnRenamed("node", "label"), "label", "left")
            labels = stored(new.select("node", F.coalesce("up", "label").alias("label")), "labels")
        for end in ("a", "b"):
            edges = edges.join(up.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up")), end)
        left = edges.filter("a_up <> b_up").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
        edges = stored(left.distinct(), "links")
        if edges.isEmpty():
            return labels
