"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, materialise

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its least node.

    Each round points every node at its neighbour of least random rank (or itself), follows the
    pointers twice, and replaces the nodes of the links by what they point at. Random ranks make
    the longest pointer path short, so the number of links falls by a constant factor a round,
    whatever the shape; a node with many links is reduced by partial aggregates. Each round's
    tables are written, so nothing is recomputed when an executor is lost. Pointers that were
    counted and are few are broadcast; else their joins shuffle.
    """
    links = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    names = materialise(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("at", F.col("node")))
    for k in range(MOST_ROUNDS):
        if links.isEmpty():
            break
        both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        rank = F.struct(F.xxhash64(F.lit(k), "b").alias("r"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64(F.lit(k), "a").alias("r"), F.col("a").alias("to"))
        point = materialise(both.groupBy("a").agg(F.min(rank).alias("best")).select(F.col("a").alias("v"), F.least("best", own)["to"].alias("to")))
        for _ in range(2):
            near = bounded(point)
            point = materialise(point.join(near.select(F.col("v").alias("to"), F.col("to").alias("next")), "to").select("v", F.col("next").alias("to")))
        near = bounded(point)
        to_a, to_b = near.toDF("a", "pa"), near.toDF("b", "pb")
        links = materialise(links.join(to_a, "a").join(to_b, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a < b").distinct())
        names = materialise(names.join(near.toDF("at", "to"), "at", "left").select("node", F.coalesce("to", "at").alias("at")))
    else:
        raise RuntimeError("components did not settle")
    least = names.groupBy("at").agg(F.min("node").alias("component"))
    return materialise(names.join(least, "at").select("node", "component"))
