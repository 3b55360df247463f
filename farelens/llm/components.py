"""Connected components of a link table by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import stored_table


def _towards_smallest(links: DataFrame, keep_smaller: bool) -> DataFrame:
    """Join every link to the smallest neighbour of its first end.

    The smallest neighbour is an aggregate, so it combines before the shuffle; the join is a
    plain inner join, which adaptive execution can split where one vertex has most links.
    """
    smallest = links.groupBy("a").agg(F.min("b").alias("least"))
    smallest = smallest.select(F.col("a").alias("hub"), F.least("a", "least").alias("least"))
    joined = links.join(smallest, links.a == smallest.hub)
    if keep_smaller:
        out = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
    else:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for each node with a link; component is the smallest node reached.

    ``links`` has long columns a and b. Links of a node to itself and repeated ones do not
    matter; rows with a null end are left out. Each round is written to the shared folder, so
    the plan stays short and a lost executor repeats one round at most. The number of rounds
    grows with the logarithm of the number of nodes; only counts come to the driver.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = links.filter("a <> b and a is not null and b is not null").distinct()
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    before = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = stored_table(_towards_smallest(both, False), "star")
        links = stored_table(_towards_smallest(links, True), "star")
        now = tuple(links.agg(F.count("a"), mark).first())
        if now == before or not now[0]:
            break
        before = now
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(found.select("component", "component").distinct())
