"""The topic report (E5): profiles, frequency tables and text clusters of a
classified catalogue. Returns the frames behind the reference's tables and
plots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tessera.operators import aggregates as A
from tessera.operators import textmine as TM
from tessera.operators import topk as T
from tessera.operators import windows as W
from tessera.operators.filters import drop_uncategorized, fill_text
from tessera.operators.joins import attach_clusters
from tessera.schemas import KEY
from tessera.session import cut_lineage


def text_clusters(df: DataFrame, text_col: str = "summary", stop_words: Iterable[str] | None = None,
                  ks=None) -> dict:
    """C3 -> C4 -> W7 -> C6 -> J6 (+ T6, W8, C7)."""
    spark = df.sparkSession
    tf = TM.tfidf(df, text_col, KEY, stop_words)
    out: dict = {"tfidf": tf.long, "vocabulary": tf.vocab_df(), "n_docs": tf.n_docs}
    if tf.n_docs < 2 or not tf.vocab:
        out.update(k=0, clusters=None)
        return out
    rows, width = cut_lineage(tf.rows), len(tf.vocab)
    models = TM.kmeans(rows, KEY, width, ks, written=True)
    inertia = models.inertia(spark)
    elbow_k = W.elbow(inertia).first()["k"] if models.cost else None
    k = TM.choose_k(elbow_k, tf.n_docs)
    if k > 1 and k not in models.centres:
        models = TM.kmeans(rows, KEY, width, [k], written=True)
    out.update(inertia=inertia, k=k, assigned=TM.kmeans_assign(rows, k, KEY, models))
    if k not in models.centres:
        out["clusters"] = None
        return out
    clustered = attach_clusters(df, out["assigned"])
    out.update(
        clusters=clustered,
        cluster_sizes=T.cluster_sizes(clustered),
        top_terms=W.top_terms(models.long(spark, k), tf.vocab_df()),
        pca=TM.pca_2d(rows, KEY, width, written=True),
    )
    return out


def topic_report(df: DataFrame, stop_words: Iterable[str] | None = None, ks=None) -> dict:
    """E5 = P12 P11 A1-A4 T3 F8 C3 C4 C6 C7 W5-W8 T6 A12.

    The rows are written once: every profile, the clustering and the tables of its
    clusters read them, and the models behind ``df`` must not run for each."""
    filled = cut_lineage(drop_uncategorized(fill_text(df)))
    numeric = [c for c in ("stars", "forks") if c in filled.columns]
    report = {
        "schema": A.schema_profile(filled),
        "nulls": A.null_profile(filled),
        "numeric": A.describe_numeric(filled, numeric) if numeric else None,
        "top_topics": T.top_values(filled, "topic", 20) if "topic" in filled.columns else None,
        "top_languages": T.top_values(filled, "language", 20) if "language" in filled.columns else None,
        "top_accounts": T.top_values(filled, "account", 20),
        "headline_topic": A.headline(filled, "topic") if "topic" in filled.columns else None,
        "headline_language": A.headline(filled, "language") if "language" in filled.columns else None,
    }
    tc = text_clusters(filled, "summary", stop_words, ks)
    report.update(tc)
    if tc.get("clusters") is not None:
        report["topics_per_cluster"] = W.topics_per_cluster(tc["clusters"], 5)
        report["examples_per_cluster"] = W.examples_per_cluster(tc["clusters"], 3)
    return report
