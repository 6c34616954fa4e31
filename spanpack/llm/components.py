"""Connected components of a link table, by alternating star contraction.

Each round joins every node to the smallest neighbour it knows, first along
larger neighbours, then along smaller ones (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). Rounds grow with the logarithm of
the longest path. A round's links go to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    kept = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(u, v)`` links with ``u > v`` to ``(node, root)``, root the smallest
    node of the component. Nodes without a link have no row; no links, no rows."""
    links = durable(links.where("u > v").distinct())
    seen = None
    for _ in range(most_rounds):
        links = durable(_small_star(_large_star(links)))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
