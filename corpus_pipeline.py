"""The corpus pipeline: ``STAGES`` are applied to the table ``documents`` in
order; each stage is written as Parquet and read again as the next one's input.

Every stage but the last returns the columns of ``documents``; the last returns
doc_id, lang, source, the token ids of the text, their number and digests."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import encoded_documents
from tessera.llm.common import cut_lineage, documents
from tessera.llm.exact_dedup import drop_copies
from tessera.llm.mixing import mix
from tessera.llm.quality import drop_poor, fit, with_statistics
from tessera.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that score 0.3 or more. Learnt from the rows whose
    doc_id is labelled; null ids are scored like any other, null and empty texts
    alike, very long texts whole; repeated rows score alike and all stay or go;
    columns stay as they are, whatever their names."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    marked = labels.select("doc_id").distinct()
    labelled = docs.join(marked, docs["doc_id"] == marked["doc_id"], "left_semi")
    model = fit(cut_lineage(with_statistics(labelled.select("doc_id", "text"))), labels, "quality")
    return drop_poor(docs, model, threshold=0.3)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the largest doc_id (null ids are
    smallest, a null text is an empty one; of rows that repeat both, one)."""
    return drop_copies(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, keep the row with the smallest doc_id
    (null ids are largest; ties go by the SHA-256 of the text). Null texts and
    those without words are near copies of one another."""
    return drop_near_copies(docs, size=3, most=3, seed=42)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources: a document comes as often as the mix takes it. A null
    source is the last one; documents without words are not taken; repeated rows
    and ids count each."""
    return mix(docs, weights=(3, 1, 2), share=1.5, most=2)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, checked by decoding them (a null text has none);
    rows with equal ids and texts each come out. An empty table stays empty in
    every stage."""
    return encoded_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding)]

#: Training a model and encoding tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else cut_lineage(docs), sf_dir)
    return docs
