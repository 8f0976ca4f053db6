"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import saved


#: Links that a task of a round takes.
PART = 100_000


def _stars(edges: DataFrame, larger: bool, parts: int) -> DataFrame:
    """One star step. ``larger``: the larger neighbours of a node move to its smallest
    neighbour; else the smaller ones and the node itself do. Its rows go on in ``parts``
    partitions, so that few links don't spread over as many files as many do."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.join(least, "u").where((F.col("v") > F.col("u")) if larger else (F.col("v") != F.col("m")))
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not larger:
        out = out.union(least.select("u", F.col("m").alias("v")))
    out = out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return out.coalesce(parts).distinct().coalesce(parts)


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component_id) for every id in ``links(a, b)``; component_id is the smallest id
    that can be reached. Links with a null end or equal ends are left out.

    Each round moves every node towards the smallest id it knows (a logarithmic number
    of rounds); rows per round never exceed the links, groups are reduced by ``min``.
    """
    edges = saved(links.where("a is not null and b is not null and a <> b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    parts = max(1, -(-edges.count() // PART))
    edges = edges.coalesce(parts)
    seen = None
    for _ in range(max_rounds):
        edges = saved(_stars(_stars(edges, True, parts), False, parts))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component_id"))).distinct()
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
