"""Connected components of a table of links, by alternating large and small stars.

Each round links every node to the least of its neighbourhood, first upwards, then downwards, until all links point at their
component's least node. Rounds are few (they grow with the logarithm of the longest chain), each is a pair of joins whose hot
keys adaptive execution can split, and each is written to the shared folder, so that no plan grows and a lost executor costs
one round. Nothing is gathered on the driver but a count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import materialize, remove


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> node, root (the least node of its component), a row for each node that isn't its own root.

    Links from a node to itself, and nulls, say nothing; repeated links count once. No link: no row.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = materialize(links.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct(), "links")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # upwards: larger neighbours go to the least of the neighbourhood
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        # downwards: a node and its smaller neighbours go to the least of them
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(floor, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = materialize(down.unionByName(floor.select("a", F.col("m").alias("b"))).distinct(), "links")
        changed = new.exceptAll(now).limit(1).count()
        remove(now)
        now = new
        if not changed:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
