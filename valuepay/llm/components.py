"""Connected components of a table of links, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuepay.session import ensure_checkpoint_dir


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``id, component``: for every id in a link the smallest id it can reach.

    ``links``: ``a, b`` of one integer type, in any order, repeats and loops allowed, null ends ignored.
    Alternating star contraction: every id links its larger neighbours to the smallest one around it,
    then its smaller neighbours, until nothing changes; the number of rounds grows with the logarithm of
    the longest path. Each round is a checkpoint in the shared folder, so a lost executor costs one round.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct().checkpoint())
    if edges.isEmpty():
        return edges.select(F.col("v").alias("id"), F.col("u").alias("component"))
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = (both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .filter("u < v").distinct())
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(down, "v")
        small = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).union(joined.select("v", F.col("m").alias("u")))
        following = small.filter("u < v").distinct().checkpoint()
        # a star forest: every id has one link, and no id that is linked to links on
        done = (following.groupBy("v").count().filter("count > 1").isEmpty()
                and following.join(following.select(F.col("v").alias("u")), "u", "left_semi").isEmpty())
        edges = following
        if done:
            return edges.select(F.col("v").alias("id"), F.col("u").alias("component"))
    raise RuntimeError(f"components not settled after {rounds} rounds")
