"""Connected components of a link table by alternating large and small stars.

Every round is a grouped minimum and a join over the links, written to the
shared folder, so nothing is gathered on the driver and a lost executor costs
one round at most.  Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proficio.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b): every linked node ``a`` but the smallest of its component, and that smallest node ``b``.

    ``links`` has bigint columns a and b; links of a node to itself are left
    out.  No links give an empty table.
    """
    signature = lambda t: tuple(t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = materialize(links.where("a <> b").select("a", "b").distinct(), "links")
    before = signature(now)
    while before[0]:
        now = materialize(_small_star(_large_star(now)), "links")
        after = signature(now)
        if after == before:
            break
        before = after
    return now
