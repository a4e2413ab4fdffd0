"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every linked node and the smallest node of its component.

    ``links`` has columns a and b.  Alternating large-star and small-star
    rounds: every node links its larger neighbours, then its smaller ones, to
    the smallest it knows.  Only minima are gathered per node, so a node with
    many links is never a single large group.  Each round is written to the
    shared folder.
    """
    now = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .where("a <> b").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # smaller neighbours of b: the a side of each row
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
                 .where("a <> b").distinct())
        now = written(small, "links")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
