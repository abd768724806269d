"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node hands its smallest neighbour to its other neighbours: a large
    star to the larger ones, a small star to the smaller ones and itself. The
    smallest is found by a partial aggregation, written, and joined back: both
    sides of the join are then plain shuffles, which Spark splits at a hub."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(back) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = cut_lineage(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    met = near.join(least, "u")
    out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots: the root
    is the smallest node that can be reached. Each round is written to the
    shared folder. Empty edges give an empty table."""
    now = cut_lineage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(most_rounds):
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == state or not sign[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = sign
        now = cut_lineage(_star(_star(now, large=True), large=False))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
