"""Connected components of a graph given as links, with joins and least labels only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodica.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in `links` (a, b): label is the least node it reaches.

    Each round a node takes the least label among its neighbours', then its label's label, so the
    number of rounds grows with the logarithm of a component's width, not with its size. A node with
    very many links is summed in the map tasks and split by the joins. Rounds end when the sum of all
    labels, which only falls, stays the same. Links to oneself and repeated links do no harm.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.distinct())
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = stored(labels.select("node", F.least("node", "near").alias("label")))
    before = None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a")
        near = near.agg(F.min("label").alias("near"))
        low = labels.join(near, F.col("node") == F.col("a"))
        low = stored(low.select("node", F.least("label", "near").alias("label")))
        above = low.select(F.col("node").alias("at"), F.col("label").alias("further"))
        jump = low.join(above, F.col("label") == F.col("at"))
        labels = stored(jump.select("node", F.least("label", "further").alias("label")))
