"""Preparation and summarisation jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.prompts import render_prompt
from tessera.operators.filters import normalise_columns
from tessera.operators.inference import predict_text
from tessera.operators.topk import limit_top
from tessera.schemas import KEY, SUMMARY_ERROR
from tessera.session import cut_lineage
from tessera.sources.catalogue import table_exists, write_stage


def prepare(df: DataFrame, sort_by: str = "created_at", limit: int | None = None) -> DataFrame:
    """T1 + T2 (sort only when a limit applies) then P5."""
    return normalise_columns(limit_top(df, limit, sort_by))


def summarise(df: DataFrame, template: str, factory, retry_errors: bool = False, pause_s: float = 0.0,
              error_col: str | None = None, tasks: int | None = None) -> DataFrame:
    """M4 = P7 -> F1 -> M1 -> U3 in one pass over the input: rows that are done
    have no prompt, are not sent to the model and keep their summary."""
    df = normalise_columns(df)
    if "summary" not in df.columns:
        df = df.withColumn("summary", F.lit(None).cast("string"))
    due = F.col("summary").isNull()
    if retry_errors:
        due = due | (F.col("summary") == F.lit(SUMMARY_ERROR))
    prompt = F.when(due, render_prompt(template, "description", "readme"))
    out = predict_text(df.withColumn("__due", due), prompt, factory, out_col="__new", error_col=error_col, pause_s=pause_s, tasks=tasks)
    return out.withColumn("summary", F.when(F.col("__due"), F.col("__new")).otherwise(F.col("summary"))).drop("__due", "__new")


def summarise_job(df: DataFrame, out_path: str, run_id: str, template: str, factory,
                  sort_by: str = "created_at", limit: int | None = None, retry_errors: bool = False,
                  pause_s: float = 0.0, tasks: int | None = None) -> None:
    """E3 = E2 -> M4 -> S7. Summaries that the run's stored output holds are
    taken from there (by key; of repeated keys with different descriptions or
    READMEs each by its own), so an interrupted run goes on where it stopped."""
    rows = prepare(df, sort_by, limit)
    spark = df.sparkSession
    if table_exists(spark, out_path):
        same = [*KEY, "description", "readme"]
        done = spark.read.parquet(out_path).filter((F.col("run_id") == run_id) & (F.col("stage") == "summarised"))
        done = done.filter(F.col("summary").isNotNull()).select(*[F.coalesce(c, F.lit("")).alias(f"__{c}") for c in same], "summary")
        done = done.groupBy(*[f"__{c}" for c in same]).agg(F.min("summary").alias("__done"))
        own = F.col("summary") if "summary" in rows.columns else F.lit(None).cast("string")
        held = rows.withColumn("__own", own).drop("summary")
        on = [F.coalesce(held[c], F.lit("")) == done[f"__{c}"] for c in same]
        rows = held.join(done, on, "left").withColumn("summary", F.coalesce("__own", "__done")).drop("__own", "__done", *[f"__{c}" for c in same])
    # Written before the stage that it was read from is overwritten.
    write_stage(cut_lineage(summarise(rows, template, factory, retry_errors, pause_s, tasks=tasks)), out_path, run_id, "summarised")
