"""Links that come out differently each time they are computed still make whole components."""

from pyspark.sql import functions as F

from cohortflow.llm.components import components
from cohortflow.llm.neardup import _hung


def test_components_of_links_that_change_when_computed_again(spark):
    @F.udf("int")
    def shuffled(i):
        import random

        return random.randint(0, 1)

    # a ring of links of which every evaluation gives another direction
    ring = spark.range(60).withColumn("flip", shuffled.asNondeterministic()("id"))
    links = ring.select(F.when(F.col("flip") == 1, F.col("id")).otherwise((F.col("id") + 1) % 60).alias("a"),
                        F.when(F.col("flip") == 1, (F.col("id") + 1) % 60).otherwise(F.col("id")).alias("b"))
    assert {r.label for r in components(links).collect()} == {0}


def test_nodes_that_share_their_firsts_hang_on_one_of_them(spark):
    # 40 nodes that share 10 firsts, a chain of two firsts, and a pair apart
    stars = [(n, f) for n in range(100, 140) for f in range(10)] + [(200, 9), (200, 50), (300, 60)]
    hung = _hung(spark.createDataFrame(stars, "node long, first long"))
    by = {r.node: r.label for r in components(hung).collect()}
    want = {n: 0 for n in [*range(10), *range(100, 140), 200, 50]} | {60: 60, 300: 60}
    assert by == want and hung.count() == 40 + 9 + 2 + 1  # a link a node and one for each other first, not one a posting
