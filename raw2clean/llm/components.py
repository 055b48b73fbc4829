"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raw2clean.llm.common import stored


#: Edges of one node from which on its minimum is broadcast, and the most such nodes.
HUB_EDGES, HUBS = 50_000, 10_000


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _with_least(edges: DataFrame, rows: int) -> DataFrame:
    """(u, v, m) for every edge: m is the smallest v of u.

    Nodes of more than ``hub`` edges are fewer than ``HUBS`` whatever the number of edges: their minima
    go to the edges, which stay where they lie. Edges of all other nodes meet their minimum by a shuffle
    in which no node brings more than ``hub`` rows.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hub = max(HUB_EDGES, rows // HUBS)
    if rows <= hub:   # no node can have more
        return edges.join(least.drop("n"), "u")
    hubs = F.broadcast(least.where(F.col("n") > hub).select("u", "m"))
    others = edges.join(hubs.select("u"), "u", "left_anti").join(least.where(F.col("n") <= hub).select("u", "m"), "u")
    return edges.join(hubs, "u").unionByName(others)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v): the smallest node it is connected with.

    Each round is one stored table of at most as many edges as there were;
    minima by node are combined before they are shuffled, and a node of many edges is
    met by its minimum where its edges lie. No component is gathered anywhere.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (signature := _signature(now)) != before:
        before, rows = signature, 2 * signature[0]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both, rows).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                 .where("u <> v").distinct())
        small = (_with_least(large, rows).select(F.col("v").alias("x"), "u", "m")
                 .select(F.explode(F.array(F.struct(F.col("x").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v"))
        now = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
