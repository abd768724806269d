"""Queries for the streaming jobs (I1-I3). Each lands data derived from the
supplied tables in the shared folder, runs the stream to completion
(``availableNow``) and reads the sink back."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tessera import stubs
from tessera.plans.summarise import summarise
from tessera.queries.models import PROMPT_SQL, SCANNED_SQL
from tessera.queries.registry import query, ts
from tessera.queries.relational import with_embeddings
from tessera.queries.views import SUMMARISED_SQL, all_words_sql, summarised, with_
from tessera.session import shared_path
from tessera.sources import standins
from tessera.streaming.jobs import checkpoint_embeddings, land_in_small_files, stream_catalogue, stream_enrich

KEY = ["account", "name"]
BATCHES = 5


@query("stream_catalogue", SCANNED_SQL.replace("'2024-06-01 00:00:00' AS last_scanned_utc,\n", ""))
def q_stream_catalogue(spark, sf_dir):
    """Two runs over one landing folder: the second lands the same listing
    again (a later scan) and must add no row; known catalogue keys are
    skipped throughout."""
    landing, out, ckpt = (shared_path(spark, k) for k in ("landing", "stream-out", "stream-ckpt"))
    lab = standins.table(spark, sf_dir, "labels")
    stored = (
        standins.catalogue(spark, sf_dir)
        .withColumn("doc_id", F.substring_index("name", "-", -1).cast("bigint"))
        .join(lab, "doc_id")
        .withColumn("name", F.when(F.col("quality") == 0, F.lit("")).otherwise(F.col("name")))
        .select(*KEY)
    )
    responses, readmes = standins.listing_responses(spark, sf_dir), standins.readme_responses(spark, sf_dir)
    for _run in range(2):
        responses.write.mode("append").json(landing)
        stream_catalogue(spark, landing, out, ckpt, stored, readmes=readmes)
    rows = spark.read.parquet(out).drop("batch_id", "last_scanned_utc")
    rows = rows.withColumns({c: ts(c) for c in ["created_at", "pushed_at"]})
    return rows.withColumns({c: F.col(c).cast("double") for c in ["stars", "forks"]})


def _land(spark, df, kind):
    path = shared_path(spark, kind)
    land_in_small_files(df, path)
    files = len(spark.read.parquet(path).inputFiles())
    return path, max(1, math.ceil(files / BATCHES))


@query(
    "stream_enrich",
    with_(SUMMARISED_SQL, f"SELECT account, name, coalesce(summary, {all_words_sql(PROMPT_SQL)}) AS summary FROM summarised"),
)
def q_stream_enrich(spark, sf_dir):
    src = summarised(spark, sf_dir)
    landing, per_batch = _land(spark, src, "enrich-landing")
    out, ckpt = shared_path(spark, "enrich-out"), shared_path(spark, "enrich-ckpt")
    stream_enrich(spark, landing, src.schema, lambda b: summarise(b, stubs.SUMMARY_TEMPLATE, stubs.first_words(None)),
                  out, ckpt, per_batch)
    return spark.read.parquet(out).select(*KEY, "summary")


@query(
    "checkpoint_embeddings",
    with_(
        SUMMARISED_SQL,
        """SELECT account, name, 64 AS dims, 1.0 AS norm FROM summarised s
WHERE s.summary IS NOT NULL AND NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = s.doc_id)""",
    ),
)
def q_checkpoint_embeddings(spark, sf_dir):
    src = with_embeddings(spark, sf_dir).drop("doc_id")
    landing, per_batch = _land(spark, src, "embed-landing")
    out, ckpt = shared_path(spark, "embed-out"), shared_path(spark, "embed-ckpt")
    checkpoint_embeddings(spark, landing, src.schema, stubs.hash_embedding(64), out, ckpt, per_batch)
    res = spark.read.parquet(out)
    pending = src.filter(F.col("summary").isNotNull() & F.col("embedding").isNull()).select(*KEY)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return res.join(pending, KEY, "left_semi").select(*KEY, F.size("embedding").alias("dims"), F.round(norm, 4).alias("norm"))
