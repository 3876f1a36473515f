"""Connected components of a graph of any size, by alternating stars.

Every round is two joins: the large star links a node's larger neighbours to
its smallest one, the small star its smaller neighbours. Rounds are written
under the shared folder, so a lost executor costs one round. Nothing but two
numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.session import materialize


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    joined = e.join(low, "u")
    up = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``edges (u, v)`` that are not their
    component's smallest node themselves; loops and repeated edges do no harm."""
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                    "edges")

    def state(x: DataFrame):
        return x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = None
    while before != (now := state(e)):
        before = now
        e = materialize(_small(_large(e)), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
