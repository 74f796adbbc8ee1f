"""Connected components of a table of links, by alternating large and small stars.

Each round ties every node to the smallest node it knows: first the larger neighbours
of a node to the smallest one, then the smaller ones. The links become stars whose centres
are the smallest nodes, in a number of rounds that grows with the logarithm of the
nodes. Rounds are written to the shared folder; nothing is brought to the driver but
two numbers that tell whether a round changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalflow.llm.common import written


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """``(node, component)`` of every node that has a link; the component is its smallest node."""
    edges = links.select(
        F.greatest(left, right).cast("long").alias("u"), F.least(left, right).cast("long").alias("v")
    )
    edges = written(edges.filter("u <> v").distinct(), "links")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = written(small.distinct(), "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
