"""Connected components of a table of links, without collecting them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over directed rows (u, v), u > v: each node hands its neighbours the least
    node near it. Large: from the whole neighbourhood to the larger ones; small: among the smaller."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for each node of a link the least node it reaches, by alternating large
    and small stars (rounds grow with the logarithm of the longest path). Links with a null end
    and loops are left out; nodes without links have no row. A hub's rows are one per neighbour."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    edges = staged(edges, "links")
    last = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == last or not state["n"]:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last = state
        edges = staged(_star(_star(edges, True), False), "stars")
