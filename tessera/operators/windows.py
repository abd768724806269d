"""Per-group loops of the reference expressed as windows.

Top-k windows (``row_number() <= k``) plan as ``WindowGroupLimit``: a
partial limit runs before the shuffle, so a hot group sends at most k rows
per map task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.aggregates import score_long
from tessera.schemas import KEY


def hash_order(seed: int, keys: Sequence[str] = tuple(KEY)) -> F.Column:
    """Reproducible pseudo-random order: ``md5(seed|k1/k2...)`` (the same
    expression runs in DuckDB)."""
    parts = [F.lit(str(seed)), F.lit("|")]
    for i, k in enumerate(keys):
        if i:
            parts.append(F.lit("/"))
        parts.append(F.coalesce(F.col(k).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


def top_per_goal(df: DataFrame, slugs: Sequence[str], k: int = 5,
                 extra: Sequence[str] = ("summary", "created_at")) -> DataFrame:
    """Per goal, rows with score > 0, by score desc then created_at
    desc (nulls last), key as final tie-break; k rows per goal."""
    long = score_long(df, slugs, keys=KEY, extra=[c for c in extra if c in df.columns])
    long = long.filter(F.col("score") > 0)
    order = [F.desc_nulls_last("score")]
    if "created_at" in long.columns:
        order.append(F.desc_nulls_last("created_at"))
    order += [F.asc(k_) for k_ in KEY]
    w = Window.partitionBy("goal").orderBy(*order)
    return long.withColumn("goal_rank", F.row_number().over(w)).filter(F.col("goal_rank") <= k)


def duplicate_rows(df: DataFrame, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Every row of a repeated key. The per-key count aggregates
    partially; the semi-join back lets AQE broadcast or split skew."""
    dup = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .filter(F.col("__n") > 1)
        .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    )
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return df.join(dup, cond, "left_semi")


def sample_per_group(df: DataFrame, group_col: str, n: int = 5, seed: int = 42,
                     keys: Sequence[str] = tuple(KEY), rank_col: str = "sample_rank") -> DataFrame:
    """Up to n rows per group in a reproducible hash order."""
    w = Window.partitionBy(group_col).orderBy(hash_order(seed, keys), *[F.asc(k) for k in keys])
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def random_per_group(registry_flat: DataFrame, seed: int = 42, group_col: str = "group",
                     account_col: str = "account") -> DataFrame:
    """One pseudo-random account per registry group (seeded)."""
    return sample_per_group(registry_flat, group_col, 1, seed, keys=[group_col, account_col]).select(
        group_col, account_col
    )


def topics_per_cluster(df: DataFrame, n: int = 5, cluster_col: str = "text_cluster", topic_col: str = "topic") -> DataFrame:
    """Most frequent original topics in each text cluster."""
    counts = df.filter(F.col(cluster_col).isNotNull() & F.col(topic_col).isNotNull()).groupBy(
        cluster_col, topic_col
    ).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(cluster_col).orderBy(F.desc("count"), F.asc(topic_col))
    return counts.withColumn("topic_rank", F.row_number().over(w)).filter(F.col("topic_rank") <= n)


def examples_per_cluster(df: DataFrame, n: int = 3, cluster_col: str = "text_cluster",
                         cols: Sequence[str] = ("name", "summary")) -> DataFrame:
    """First rows (by key) of each cluster."""
    w = Window.partitionBy(cluster_col).orderBy(*[F.asc(k) for k in KEY])
    keep = [c for c in dict.fromkeys([*KEY, *cols]) if c in df.columns]
    return (
        df.filter(F.col(cluster_col).isNotNull())
        .withColumn("example_rank", F.row_number().over(w))
        .filter(F.col("example_rank") <= n)
        .select(cluster_col, "example_rank", *keep)
    )


def elbow(inertia: DataFrame, k_col: str = "k", v_col: str = "inertia") -> DataFrame:
    """K at the largest second difference (first on ties); the smallest
    K with fewer than three values; 2 with none. Works on the <= 14-row
    inertia table by self-joins on k + 1 and k + 2."""
    a = inertia.select(F.col(k_col).alias("k0"), F.col(v_col).alias("v0"))
    b = inertia.select(F.col(k_col).alias("k1"), F.col(v_col).alias("v1"))
    c = inertia.select(F.col(k_col).alias("k2"), F.col(v_col).alias("v2"))
    trip = a.join(b, F.col("k1") == F.col("k0") + 1).join(c, F.col("k2") == F.col("k0") + 2)
    d2 = trip.select(F.col("k1").alias("k"), (F.col("v2") - 2 * F.col("v1") + F.col("v0")).alias("d2"))
    best = d2.orderBy(F.desc("d2"), F.asc("k")).limit(1).select("k")
    fallback = inertia.agg(F.coalesce(F.min(k_col), F.lit(2)).alias("k"))
    ranked = best.withColumn("__p", F.lit(0)).unionByName(fallback.withColumn("__p", F.lit(1)))
    return ranked.orderBy("__p").limit(1).select(F.col("k").cast("int").alias("k"))


def top_terms(centers: DataFrame, vocab: DataFrame, n: int = 10) -> DataFrame:
    """Heaviest terms per centroid. ``centers``: (cluster, term_index,
    weight) long form; ties go to the larger index (descending argsort)."""
    w = Window.partitionBy("cluster").orderBy(F.desc("weight"), F.desc("term_index"))
    top = centers.withColumn("term_rank", F.row_number().over(w)).filter(F.col("term_rank") <= n)
    return top.join(vocab.select("term_index", "term"), "term_index").select("cluster", "term_rank", "term", "weight")
