"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.schemas import KEY
from tessera.session import cut_lineage

#: Bits of ``monotonically_increasing_id`` below the partition's number.
PLACE_BITS = 33


def seed_topics(spark, topics: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t, i) for i, t in enumerate(topics)], "topic string, rank int")


def extend_vocabulary(seeds: DataFrame, found: DataFrame, order_col: str = "seen_at",
                      offset: int | None = None) -> DataFrame:
    """Seed topics in their order, then new topics by first appearance.

    ``seeds``: (topic, rank) with ranks 0..s-1; ``found``: (topic,
    <order_col>) for every answer. New topics aggregate partially (min of
    the order) before the shuffle, so a topic given a million times costs
    one row per task. New topics are ranked by a distributed sort."""
    if offset is None:  # number of seed topics, when the caller does not know it
        offset = seeds.count()
    new = (
        found.filter(F.col("topic").isNotNull())
        .join(seeds.select("topic"), "topic", "left_anti")
        .groupBy("topic")
        .agg(F.min(order_col).alias("first_seen"))
    )
    placed, counts = in_order(new, "first_seen", "topic")
    ranked = placed.select("topic", (place_rank(counts) + offset).cast("int").alias("rank"))
    return seeds.select("topic", F.col("rank").cast("int")).unionByName(ranked)


def in_order(df: DataFrame, *by: str) -> tuple[DataFrame, dict[int, int]]:
    """``df`` sorted into a written table, with ``__place``, a number that
    grows along the order, and how many rows each of its partitions has (one
    number for each, on the driver). Ties get places of their own."""
    placed = cut_lineage(df.orderBy(*by).withColumn("__place", F.monotonically_increasing_id()))
    part = F.shiftright("__place", PLACE_BITS)
    return placed, {r[0]: r[1] for r in placed.groupBy(part.alias("p")).count().orderBy("p").collect()}


def place_of(rank: int, counts: dict[int, int]) -> int:
    """The place of the row that ``rank`` rows come before."""
    for part in sorted(counts):
        if rank < counts[part]:
            return (part << PLACE_BITS) + rank
        rank -= counts[part]
    raise IndexError(rank)


def place_rank(counts: dict[int, int]) -> F.Column:
    """The rank (from 0) of a place."""
    before, offsets = 0, []
    for part in sorted(counts):
        offsets += [F.lit(part), F.lit(before)]
        before += counts[part]
    begin = F.create_map(*offsets)[F.shiftright("__place", PLACE_BITS)] if offsets else F.lit(0)
    return begin + F.col("__place").bitwiseAND((1 << PLACE_BITS) - 1)


def target_accounts(targets: DataFrame, picks: DataFrame, col: str = "account") -> DataFrame:
    """Target list plus picks, duplicates removed."""
    return targets.select(col).union(picks.select(col)).distinct()


def merge_results(base: DataFrame, new: DataFrame, col: str = "summary",
                  keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Rows keep their earlier value unless a new one was computed."""
    n = new.groupBy(*keys).agg(F.min(col).alias("__new"))  # one row a key
    b = base if col in base.columns else base.withColumn(col, F.lit(None).cast("string"))
    return b.join(n, list(keys), "left").withColumn(col, F.coalesce(F.col("__new"), F.col(col))).drop("__new")
