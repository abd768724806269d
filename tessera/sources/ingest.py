"""Registry and listing sources (S1-S3) and the catalogue projection (P1,
P2, P4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.joins import allow_list
from tessera.schemas import (
    CATALOGUE_COLUMNS,
    LISTING_ITEM,
    NO_DESCRIPTION,
    NO_LANGUAGE,
    README_MISSING,
)


def read_registry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed registry documents, each a JSON mapping of group -> list of
    accounts: one per file, or (``lines``) one per line. Anything but a mapping fails the job; a group
    whose value is not a list gets a null ``accounts``."""
    raw = spark.read.option("wholetext", str(not lines).lower()).text(path)
    mapping = F.from_json("value", "map<string,string>")
    refused = F.raise_error(F.concat(F.lit("the registry is not a mapping: "), F.substring("value", 1, 80)))
    groups = raw.select(F.explode(F.when(mapping.isNull(), refused.cast("map<string,string>")).otherwise(mapping)).alias("group", "raw"))
    return groups.select("group", F.from_json("raw", "array<string>").alias("accounts"))


def flatten_registry(registry: DataFrame, allow: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """One row per account name; groups that are not lists are skipped;
    duplicates removed; an empty allow list means no filter (J2)."""
    flat = registry.filter(F.col("accounts").isNotNull()).select(
        "group", F.explode("accounts").alias("account")
    ).filter(F.col("account").isNotNull())
    flat = allow_list(flat, allow)
    return flat


def account_names(registry: DataFrame, allow: DataFrame | Sequence[str] | None = None) -> DataFrame:
    return flatten_registry(registry, allow).select("account").distinct()


def explode_listing(responses: DataFrame, objects_only: bool = True) -> DataFrame:
    """Landed listing responses ``(account, page, body)`` -> one row per
    item with its position. Non-object items are skipped (keep them with
    ``objects_only=False`` when a page cap must count them, as S3 does)."""
    items = responses.select(
        "account", "page", F.posexplode(F.from_json("body", "array<string>")).alias("pos", "item")
    )
    return only_objects(items) if objects_only else items


def only_objects(items: DataFrame) -> DataFrame:
    return items.filter(F.from_json("item", "map<string,string>").isNotNull())


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """S2 from files: JSON lines ``{"account": .., "page": .., "body": ..}``.
    What can't be read is in ``corrupt_listing``."""
    return explode_listing(_landed(spark, path))


def corrupt_listing(spark: SparkSession, path: str) -> DataFrame:
    """The landed lines that ``read_listing`` can't use, as (account, page,
    record): lines that are not JSON, and bodies that are not an array."""
    raw = _landed(spark, path)
    bad = F.col("_corrupt_record").isNotNull() | F.from_json("body", "array<string>").isNull()
    return raw.filter(bad).select("account", "page", F.coalesce("_corrupt_record", "body").alias("record"))


def _landed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("account string, page bigint, body string, _corrupt_record string").json(path)


def cap_per_account(items: DataFrame, n: int | None = None) -> DataFrame:
    """S3: keep all items, or only the first n of each account, counting
    every item, objects or not. The top-n
    window runs a partial limit before the shuffle."""
    if n is None:
        return items
    w = Window.partitionBy("account").orderBy("page", "pos")
    return items.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def to_catalogue(items: DataFrame, scan_time: F.Column | None = None) -> DataFrame:
    """P2 (+P4): listing items -> catalogue rows. Nameless items (missing or
    empty name) are dropped. description/language default when missing,
    null or empty; stars, forks default to 0 and url to '' only when the
    field is missing (an explicit null stays null)."""
    s = F.from_json("item", LISTING_ITEM)
    m = F.from_json("item", "map<string,string>")
    parsed = items.select("*", s.alias("__s"), m.alias("__m"))

    def has(k):
        return F.map_contains_key(F.col("__m"), F.lit(k))

    def ts(c):
        return F.try_to_timestamp(F.col(c))

    out = parsed.filter(F.length(F.col("__s.name")) > 0).select(
        *[c for c in items.columns if c != "item"],
        F.col("__s.name").alias("name"),
        F.coalesce(F.nullif(F.col("__s.description"), F.lit("")), F.lit(NO_DESCRIPTION)).alias("description"),
        F.when(has("stargazers_count"), F.col("__s.stargazers_count")).otherwise(F.lit(0)).cast("bigint").alias("stars"),
        F.when(has("forks_count"), F.col("__s.forks_count")).otherwise(F.lit(0)).cast("bigint").alias("forks"),
        F.coalesce(F.nullif(F.col("__s.language"), F.lit("")), F.lit(NO_LANGUAGE)).alias("language"),
        F.when(has("html_url"), F.col("__s.html_url")).otherwise(F.lit("")).alias("url"),
        F.lit(README_MISSING).alias("readme_snippet"),
        (scan_time if scan_time is not None else F.current_timestamp()).alias("last_scanned_utc"),
        ts("__s.created_at").alias("created_at"),
        ts("__s.pushed_at").alias("pushed_at"),
    )
    return out


def stamp_scan_time(df: DataFrame) -> DataFrame:
    """Scan time (one value per job; the reference stamps per row)."""
    return df.withColumn("last_scanned_utc", F.current_timestamp())


def project_catalogue(df: DataFrame) -> DataFrame:
    """Fixed column order of the catalogue; missing columns become null."""
    from tessera.schemas import CATALOGUE

    types = {f.name: f.dataType for f in CATALOGUE.fields}
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in CATALOGUE_COLUMNS
        ]
    )
