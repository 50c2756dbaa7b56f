"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamegrain.llm.common import write_out


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every end of a link ``(a, b)``; the label is a node of the component.

    Each round every node points to the smallest node it is linked to, and from there one step further; links are
    then drawn between what their ends point to. A star is done in two rounds, a chain in a logarithm of its length.
    Nodes with many links are summed before the shuffle. Links and labels stay tables.
    """
    links = write_out(links.select("a", "b").where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = write_out(nodes.withColumn("label", F.col("node")), "labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        least = write_out(least, "least")
        step = least.select(F.col("a").alias("to"), F.col("to").alias("further"))
        jump = write_out(least.join(step, "to").select("a", F.col("further").alias("to")), "jump")
        moved = jump.select(F.col("a").alias("label"), "to")
        labels = write_out(
            labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels"
        )
        from_a, from_b = jump.select("a", F.col("to").alias("x")), jump.select(F.col("a").alias("b"), F.col("to").alias("y"))
        drawn = links.join(from_a, "a").join(from_b, "b").where("x <> y")
        links = write_out(drawn.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    return labels
