"""Batch topic classifier (M9): embed -> reduce -> density clusters ->
sample and label each cluster -> assign topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.jsonx import parse_vector
from tessera.operators.aggregates import final_topics
from tessera.operators.filters import embedding_due, normalise_columns
from tessera.operators.inference import embedding_udf
from tessera.operators.joins import assign_topic, map_labels
from tessera.operators.vectors import density_clusters, density_hierarchy, reduce_dims
from tessera.plans.classify import label_clusters
from tessera.schemas import EMBED_BATCH, KEY, MIN_CLUSTER_SIZE, REDUCED_DIMS, UNCATEGORIZED
from tessera.session import cut_lineage


def embed_pending(df: DataFrame, factory, text_col: str = "summary", batch_size: int = EMBED_BATCH,
                  embed_errors: bool = True) -> DataFrame:
    """M5 over P8 rows, in one pass; done rows pass through, whatever their
    key. The result is written, so the model runs once for each row."""
    df = normalise_columns(df)
    if "embedding" not in df.columns:
        df = df.withColumn("embedding", F.lit(None).cast("array<double>"))
    elif isinstance(df.schema["embedding"].dataType, T.StringType):
        df = df.withColumn("embedding", parse_vector("embedding"))  # list text from CSV
    else:
        df = df.withColumn("embedding", F.transform("embedding", lambda x: x.cast("double")))
    due = F.coalesce(embedding_due(text_col, "embedding", embed_errors), F.lit(False))
    text = F.when(due, F.col(text_col))  # the model skips null texts
    new = F.transform(embedding_udf(factory, batch_size)(text), lambda x: x.cast("double"))
    return cut_lineage(df.withColumn("__due", due).withColumn("__e", new).withColumn(
        "embedding", F.when(F.col("__due"), F.col("__e")).otherwise(F.col("embedding"))).drop("__due", "__e"))


def classify_batch(df: DataFrame, embed_factory, label_factory, label_template: str,
                   eps: float | None = None, min_size: int = MIN_CLUSTER_SIZE, dims: int = REDUCED_DIMS,
                   text_col: str = "summary") -> tuple[DataFrame, DataFrame]:
    """M9. Returns (rows with ``topic``, final topic table). No vector at all
    gives every row ``Uncategorized``; an empty input gives empty output."""
    if "topic" in df.columns:
        df = df.drop("topic")  # rerun on a classified frame
    spark = df.sparkSession
    unc = spark.createDataFrame([(UNCATEGORIZED,)], "topic string")
    if df.isEmpty():
        return df.withColumn("topic", F.lit(None).cast("string")), unc.limit(0)
    rows = embed_pending(df.withColumn("__id", F.monotonically_increasing_id()), embed_factory, text_col)  # written with the ids
    # Texts stay in that one table: only ids and vectors go through the clustering.
    with_vec = rows.filter(F.col("embedding").isNotNull()).select("__id", "embedding")
    if with_vec.isEmpty():
        return rows.drop("__id").withColumn("topic", F.lit(UNCATEGORIZED)), unc
    reduced = cut_lineage(reduce_dims(with_vec, dims, "embedding", "reduced").select("__id", "reduced"))
    if eps is None:
        clusters = density_hierarchy(reduced, min_size, "__id", "reduced", "euclidean")
    else:
        clusters = density_clusters(reduced, eps, min_size, "__id", "reduced", "euclidean")
    clusters = cut_lineage(clusters.select("__id", "cluster_id"))
    clustered = rows.select("__id", text_col, *KEY).join(clusters.filter(F.col("cluster_id") != -1), "__id")  # outliers have no label
    # Written: rows and topic table must see the same answers.
    labels = cut_lineage(label_clusters(clustered, label_template, label_factory, text_col=text_col))
    topics = map_labels(clusters, labels)
    out = assign_topic(rows, topics.select("__id", "topic"), keys=["__id"]).drop("__id")
    return out, final_topics(out)
