"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links of each node moved to its smallest neighbour: those to larger nodes, or those to smaller ones."""
    around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = around.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                             F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link: root is the smallest node that can be reached.

    Links run from the larger to the smaller end. Each round is written to the shared folder; the number of rounds grows
    with the logarithm of the longest chain, and only a count and a checksum come back to the driver.
    """
    pair = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now, before = written(pair, "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = written(_star(_star(now, True), False), "links")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
