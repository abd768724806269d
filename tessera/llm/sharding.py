"""Sharding by rendezvous hashing.

Each record goes to the shard with the best score for its key; a score depends
on key, shard and the shard's weight alone. A further shard takes records into
itself and moves no other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: least -ln(u) / weight, where u in (0, 1] hashes key
    and shard. A shard of weight 0 gets nothing."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + 1) / F.lit(float(1 << 53))
            scores.append(F.struct((-F.ln(u) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*scores))["shard"] if len(scores) > 1 else scores[0]["shard"]


def shard_documents(docs: DataFrame, weights: Sequence[float], added: float = 1.0, buckets: int = 1024) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``grown_shard`` is the shard with one more of weight ``added``. Slots count
    a shard's rows from 0 without gaps: rows are numbered in ``buckets`` buckets
    of a shard, by a hash of doc_id and text, and each bucket begins where the
    ones before it end, so no task orders a whole shard, or all rows of one id. A null text has size 1 and CRC 0; a null
    doc_id is a key like any other; rows of equal doc_id share a shard and get
    their own slots. Further columns are ignored; an empty table gives an empty
    one."""
    text = F.coalesce("text", F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, added]).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", text, F.lit("slot")), F.lit(buckets)).alias("bucket"),
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = placed.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("begin"))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1).join(begins, ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", (F.col("begin") + F.col("place")).alias("slot"), "grown_shard")
