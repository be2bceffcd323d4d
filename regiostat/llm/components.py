"""Connected components of a table of links, by star contraction.

Alternates two steps until nothing changes: every node hands its larger
neighbours to the smallest node it sees, then its smaller ones.  Each step is
a grouped minimum and a join on one node, so a hub's links are never gathered
in one place; tables are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, saved_counted


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) of every node that has a link and is not the smallest."""
    big, small = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    edges, state = saved_counted(links.select(big.alias("u"), small.alias("v")).where("u <> v").distinct(), "edges")
    while state["n"]:
        # large star: neighbours above u go to the smallest of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        least = least.select("x", F.least("m", "x").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.distinct(), "edges")
        # small star: neighbours below u, and u, go to the smallest of them
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        below = large.join(least, F.col("u") == F.col("x")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = state
        edges, state = saved_counted(
            below.unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def hooked(comps: DataFrame | None, met: DataFrame) -> DataFrame:
    """Cheap progress between rounds: ``met`` (ca, cb) says which components were found to be one.

    Each hooks onto the smallest it met, and chains are cut short twice; what
    longer chains leave divided, :func:`components` joins in the end.
    """
    big, small = F.greatest("ca", "cb"), F.least("ca", "cb")
    parent = saved(met.groupBy(big.alias("c")).agg(F.min(small).alias("p")), "parents")
    for _ in range(2):
        up = parent.select(F.col("c").alias("x"), F.col("p").alias("y"))
        parent = parent.join(up, F.col("p") == F.col("x"), "left").select("c", F.coalesce("y", "p").alias("p"))
    parent = saved(parent, "parents")
    if comps is None:
        return parent.select(F.col("c").alias("node"), F.col("p").alias("component"))
    moved = comps.join(parent, F.col("component") == F.col("c"), "left").select("node", F.coalesce("p", "component").alias("component"))
    every = moved.unionByName(parent.select(F.col("c").alias("node"), F.col("p").alias("component")))
    return saved(every.groupBy("node").agg(F.min("component").alias("component")), "hooked")
