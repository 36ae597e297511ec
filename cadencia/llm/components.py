"""Connected components of a link table, as alternating star joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadencia.session import materialize


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``); the root is the smallest node reachable.

    Each round points every node and its larger neighbours to the smallest neighbour known (large star), then
    every node's smaller neighbours to the smallest of them (small star). Links shrink towards one star per component; a
    round's table is written, so lineage stays short. Minima combine before the shuffle, and a hot node is only the
    hot side of a join with one row per node, which AQE can split.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "cc-links")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: larger neighbours of u move to m.
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "cc-large")
        # Small star: u and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
