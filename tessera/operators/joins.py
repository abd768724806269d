"""Joins (J1-J7, J9).

Small sides here are either driver-supplied lists (prompts, goals, topic
maps), which are attached as literal arrays and exploded, or tables whose
size is only known at run time, which are left to AQE: it broadcasts them
when the measured size is under the threshold and otherwise keeps the
shuffled join (with skew splitting)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import truncate_readme
from tessera.schemas import KEY, README_CHARS, README_MISSING, UNCATEGORIZED


def allow_list(accounts: DataFrame, allowed: DataFrame | Sequence[str] | None, col: str = "account") -> DataFrame:
    """Membership filter; ``None`` or an empty list means no filter."""
    if allowed is None:
        return accounts
    if not isinstance(allowed, DataFrame):
        allowed = list(allowed)
        if not allowed:
            return accounts
        return accounts.filter(F.col(col).isin(allowed))
    return accounts.join(allowed.select(F.col(allowed.columns[0]).alias(col)).distinct(), col, "left_semi")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by an explicit order. A grouped ``min`` of
    a struct aggregates partially before the shuffle, so a hot key costs no
    more than any other."""
    payload = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"__v_{c}") for c in payload if c not in order]))
    out = df.groupBy(*keys).agg(first.alias("__first"))
    return out.select(
        *keys,
        *[F.col(f"__first.{c}").alias(c) if c in order else F.col(f"__first.__v_{c}").alias(c) for c in payload],
    )


#: Bits of the key filter, and of one bitmap of it: 4,096 bitmaps of 4 KB at most.
FILTER_BITS, BITMAP_BITS = 27, 15


def maybe_among(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``df`` whose key can be one of ``others``: all that are, and
    those whose hash happens to meet one of theirs. The hashes are set in
    bitmaps, a task's own first; at 16 MB they are sent to every task, so ``df``
    is filtered where it is read and only what is left is shuffled."""
    place = F.xxhash64(*keys).bitwiseAND((1 << FILTER_BITS) - 1)
    bucket, bit = F.shiftright(place, BITMAP_BITS), place.bitwiseAND((1 << BITMAP_BITS) - 1)
    bitmaps = others.select(bucket.alias("__bucket"), bit.alias("bit")).groupBy("__bucket").agg(F.bitmap_construct_agg("bit").alias("__bits"))
    joined = df.withColumns({"__bucket": bucket, "__bit": bit}).join(F.broadcast(bitmaps), "__bucket")
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright("__bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.expr("shiftleft(1, cast(__bit & 7 as int))")
    return joined.filter(byte.bitwiseAND(mask) != 0).select(*df.columns)


def new_items(listing: DataFrame, catalogue: DataFrame, order: Sequence[str] = ("page", "pos"),
              keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Items whose key is not yet catalogued (stored rows with an empty
    key part are ignored); repeats inside one run keep the first. Of the
    catalogue only keys that the listing may hold are shuffled."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.length(F.col(k)) > 0)  # null parts drop out too
    known = maybe_among(catalogue.select(*keys).filter(cond), listing.select(*keys), list(keys))
    fresh = listing.join(known, list(keys), "left_anti")
    return first_per_key(fresh, list(keys), list(order))


def attach_readme(catalogue: DataFrame, readmes: DataFrame, n: int = README_CHARS,
                  out_col: str = "readme_snippet") -> DataFrame:
    """README text where the fetch succeeded (status 200 and a body);
    every failure path keeps the default. An empty README stays empty."""
    # One response for each key: a success before a failure.
    r = readmes.select(*KEY, F.col("status").alias("__status"), F.col("body").alias("__body"))
    r = first_per_key(r.withColumn("__bad", ~((F.col("__status") == 200) & F.col("__body").isNotNull())), KEY, ["__bad", "__body", "__status"]).drop("__bad")
    j = catalogue.drop(out_col).join(r, KEY, "left") if out_col in catalogue.columns else catalogue.join(r, KEY, "left")
    ok = (F.col("__status") == 200) & F.col("__body").isNotNull()
    return j.withColumn(out_col, F.when(ok, truncate_readme(F.col("__body"), n)).otherwise(F.lit(README_MISSING))).drop(
        "__status", "__body"
    )


def assign_topic(df: DataFrame, clustered: DataFrame, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Left join of topic onto all rows; no topic -> Uncategorized.
    A ``topic`` column already on ``df`` is replaced."""
    base = df.drop("topic") if "topic" in df.columns else df
    t = clustered.groupBy(*keys).agg(F.min("topic").alias("topic"))  # one row a key: rows in = rows out
    return base.join(t, list(keys), "left").withColumn(
        "topic", F.coalesce(F.col("topic"), F.lit(UNCATEGORIZED))
    )


def map_labels(clusters: DataFrame, topic_map: DataFrame, id_col: str = "cluster_id") -> DataFrame:
    """Cluster id -> label; -1 (outliers) -> Uncategorized. The map has
    one row per cluster; AQE broadcasts it when small."""
    m = topic_map.select(F.col(id_col).alias("__cid"), F.col("label").alias("__label"))
    # Most rows may be outliers: a null key keeps them out of the join's shuffle group.
    own = F.when(F.col(id_col) != -1, F.col(id_col))
    j = clusters.withColumn("__own", own).join(m, F.col("__own") == F.col("__cid"), "left").drop("__own")
    return j.withColumn(
        "topic",
        F.when(F.col(id_col) == -1, F.lit(UNCATEGORIZED)).otherwise(F.coalesce(F.col("__label"), F.lit(UNCATEGORIZED))),
    ).drop("__cid", "__label")


def attach_clusters(df: DataFrame, assigned: DataFrame, keys: Sequence[str] = tuple(KEY),
                    col: str = "text_cluster") -> DataFrame:
    """Cluster label joined back; rows not clustered stay null."""
    base = df.drop(col) if col in df.columns else df
    return base.join(assigned.groupBy(*keys).agg(F.min(col).alias(col)), list(keys), "left")


def _literal_rows(rows: Sequence[Mapping[str, str]], fields: Sequence[str]):
    return F.array(*[F.struct(*[F.lit(r[f]).alias(f) for f in fields]) for r in rows])


def cross_prompts(sample: DataFrame, prompts: Sequence[Mapping[str, str]]) -> DataFrame:
    """Every sampled row with every prompt. The prompt list lives on the
    driver and is attached as a literal array, then exploded: no join."""
    arr = _literal_rows(prompts, ["prompt_name", "template"])
    return sample.withColumn("__p", F.explode(arr)).select(
        "*", F.col("__p.prompt_name").alias("prompt_name"), F.col("__p.template").alias("template")
    ).drop("__p")


def cross_goals(df: DataFrame, goals: Sequence[Mapping[str, str]]) -> DataFrame:
    """Every scorable row against every goal, long form."""
    arr = _literal_rows(goals, ["name", "description"])
    return df.withColumn("__g", F.explode(arr)).select(
        "*", F.col("__g.name").alias("goal"), F.col("__g.description").alias("goal_description")
    ).drop("__g")
