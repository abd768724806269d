"""Flagship query for the smoke check: summarise the catalogue with the stub
model, classify topics with an open vocabulary, count topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera import stubs
from tessera.operators.topk import top_values
from tessera.plans.classify import classify_open_vocab
from tessera.plans.summarise import prepare, summarise
from tessera.session import cut_lineage
from tessera.sources import standins


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = prepare(standins.catalogue(spark, sf_dir))
    summed = cut_lineage(summarise(cat, stubs.SUMMARY_TEMPLATE, stubs.first_words(None)))
    topics, _vocab = classify_open_vocab(summed, stubs.TOPIC_TEMPLATE, stubs.seed_topic(), stubs.SEED_TOPICS)
    return top_values(topics, "topic", 20)
