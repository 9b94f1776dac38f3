"""Connected components of links by spreading the smallest label, with shortcuts; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortflow.session import settle


def components(links: DataFrame) -> DataFrame:
    """links: a, b. Returns node and label, the smallest node reachable, for every node in a link.

    A round takes the smallest label among a node's own and its neighbours' and then the label of that label, so that
    long chains take a number of rounds like the logarithm of their length. Labels are summed up before they are
    shuffled; nothing but a count of changes reaches the driver.
    """
    # both ways from one evaluation: a link that only one way has would keep a label from spreading
    ways = F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("way")
    both = settle(links.filter("a <> b").select(ways).select("way.a", "way.b").distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least")).select("node", F.least("node", "_least").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("_of")).agg(F.min("label").alias("_near"))
        spread = settle(labels.join(near, F.col("node") == F.col("_of")).select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new")), "spread")
        ahead = spread.select(F.col("node").alias("_at"), F.col("_new").alias("_ahead"))
        after = settle(spread.join(ahead, F.col("_new") == F.col("_at")).select("node", "_old", F.least("_new", "_ahead").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("label <> _old").isEmpty():
            return labels
