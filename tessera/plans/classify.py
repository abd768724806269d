"""Classification jobs: open-vocabulary topics (M6), cluster labels (M7),
goal scores (M8), prompt comparison (M10) and the dispatcher (E4)."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import jsonx
from tessera.functions.prompts import around, render, render_goal_prompt, topic_list_text
from tessera.functions.text import strip_label
from tessera.operators.aggregates import cluster_prompt_text
from tessera.operators.filters import normalise_columns, scorable
from tessera.operators.inference import build, predict_text
from tessera.operators.joins import cross_prompts
from tessera.operators.sets import extend_vocabulary, in_order, place_of, seed_topics
from tessera.operators.topk import sample_rows
from tessera.operators.windows import sample_per_group
from tessera.plans.summarise import prepare
from tessera.schemas import KEY, LABEL_SAMPLE
from tessera.session import cut_lineage
from tessera.sources.catalogue import write_stage

# The open-vocabulary classifier's first wave, and how much larger each next one
# is, to the end: at most half of the rows come after the last new vocabulary.
# Waves of one row reproduce the sequential reference.
FIRST_WAVE, WAVE_GROWTH = 64, 2


def order_key(df: DataFrame, sort_by: str | None = "created_at") -> F.Column:
    """Processing order as one sortable value: newest first (nulls last),
    then key."""
    if sort_by and sort_by in df.columns:
        first = F.coalesce(-F.unix_micros(F.col(sort_by).cast("timestamp")), F.lit(2**62))
    else:
        first = F.lit(0)
    return F.struct(first.alias("t"), *[F.col(k) for k in KEY])


def wave_sizes() -> Iterator[int]:
    size = FIRST_WAVE
    while True:
        yield size
        size *= WAVE_GROWTH


class Listing:
    """A model of summaries: their prompts list every known topic. ``around`` (a
    broadcast of ``prompts.around``) is sent once to an executor; put into the
    rows, the list would be sent with each of them."""

    def __init__(self, factory, around):
        self.model, self.around = build(factory), around.value

    def __call__(self, summary: str) -> str:
        return self.model(summary.join(self.around))


def classify_open_vocab(df: DataFrame, template: str, factory, topics: Sequence[str],
                        waves: Sequence[int] | None = None, sort_by: str | None = "created_at",
                        pause_s: float = 0.0, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """M6: a topic per row, chosen from (or added to) a growing vocabulary;
    returns the rows and the vocabulary (topic, rank).

    The input is sorted once into a written table whose row numbers give every
    row its exact place, ties included, so wave sizes are exact. All rows of a
    wave see the vocabulary known before it; new topics are added in order of
    first appearance (U1). Waves grow by ``WAVE_GROWTH`` until the input ends
    (``waves`` gives other sizes; a last one takes the rest), so every row sees
    all topics of all waves before its own, however many.
    Each wave's answers are written once, then used for output and vocabulary.
    The driver holds the topics known before the last wave, for the prompts."""
    df = normalise_columns(df)
    spark = df.sparkSession
    vocab = seed_topics(spark, list(topics))
    if "topic" in df.columns:
        df = df.drop("topic")
    placed, counts = in_order(df.withColumn("__ord", order_key(df, sort_by)), "__ord")
    n = sum(counts.values())
    if n == 0:
        return df.withColumn("topic", F.lit(None).cast("string")), vocab
    bounds, cum = [0], 0
    for w in waves if waves is not None else wave_sizes():
        cum += w
        if cum >= n:
            break
        bounds.append(place_of(cum, counts))
    parts: list[DataFrame] = []
    known = list(topics)
    for i, lo in enumerate(bounds):
        last = i + 1 == len(bounds)
        wave = placed.filter(F.col("__place") >= lo)
        if not last:
            wave = wave.filter(F.col("__place") < bounds[i + 1])
        listed = spark.sparkContext.broadcast(around(template, "summary", {"topic_list": topic_list_text(known)}))
        summary = F.coalesce(F.col("summary").cast("string"), F.lit(""))
        answered = cut_lineage(predict_text(wave, summary, partial(Listing, factory, listed), out_col="topic", on_error="raise", pause_s=pause_s, tasks=tasks))
        listed.destroy()
        parts.append(answered)
        vocab = cut_lineage(extend_vocabulary(vocab, answered.select("topic", F.col("__place").alias("seen_at")), offset=len(known)))
        if not last:
            known += [r["topic"] for r in sorted(vocab.filter(F.col("rank") >= len(known)).collect(), key=lambda r: r["rank"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("__ord", "__place"), vocab


def label_clusters(clustered: DataFrame, template: str, factory, cluster_col: str = "cluster_id",
                   text_col: str = "summary", n: int = LABEL_SAMPLE, seed: int = 42, pause_s: float = 0.0,
                   tasks: int | None = None) -> DataFrame:
    """M7: one short label per cluster from up to n sampled texts (W3 + A11);
    outliers (-1) are never sent. A failing call fails the job."""
    members = clustered.filter(F.col(cluster_col) != -1)
    sample = sample_per_group(members, cluster_col, n, seed)
    groups = cluster_prompt_text(sample, cluster_col, text_col)
    prompt = render(template, {"summaries": "summaries"})
    labelled = predict_text(groups, prompt, factory, out_col="label", on_error="raise", pause_s=pause_s, tasks=tasks)
    return labelled.select(cluster_col, strip_label("label").alias("label"))


def classify_goals(df: DataFrame, template: str, goals: Sequence[Mapping[str, str]], factory, pause_s: float = 0.0,
                   tasks: int | None = None) -> DataFrame:
    """M8 = P9 -> F3 -> M1 -> F5 -> F6, in one pass over the input. A failed
    call gives an empty answer (every goal 0 with the fixed reason); rows that
    are not scorable have no prompt, are not sent and keep null scores. Goal
    columns are read from one parsed map per row: no pivot, no shuffle."""
    df = normalise_columns(df)
    ok = F.coalesce(scorable("summary"), F.lit(False))
    prompt = F.when(ok, render_goal_prompt(template, goals))
    answered = predict_text(df.withColumn("__ok", ok), prompt, factory, out_col="__answer", on_error="sentinel",
                            error_value="", pause_s=pause_s, tasks=tasks)
    cols = jsonx.goal_score_columns(jsonx.goal_map(jsonx.extract_json("__answer")), goals)
    return answered.select(*df.columns, *[F.when(F.col("__ok"), c).alias(k) for k, c in cols.items()])


def compare_prompts(df: DataFrame, prompts: Sequence[Mapping[str, str]], factory, n: int = 10,
                    seed: int = 62, pause_s: float = 0.0, tasks: int | None = None) -> DataFrame:
    """M10 = T5 -> J7 -> M1 -> one column per prompt beside the old summary."""
    df = normalise_columns(df)
    sample = sample_rows(df, n, seed).select(*KEY, "description", "readme",
                                             F.col("summary").alias("original_summary"))
    crossed = cross_prompts(sample, prompts)
    # Each prompt row renders its own template; templates are split on the
    # driver, so text inside the data is never expanded.
    prompt = None
    for p in prompts:
        r = render(p["template"], {"description": "description", "readme": "readme"})
        is_p = F.col("prompt_name") == F.lit(p["prompt_name"])
        prompt = F.when(is_p, r) if prompt is None else prompt.when(is_p, r)
    answered = predict_text(crossed, prompt, factory, out_col="answer", pause_s=pause_s, tasks=tasks)
    names = [p["prompt_name"] for p in prompts]
    return (
        answered.groupBy(*KEY, "description", "original_summary")
        .pivot("prompt_name", names)
        .agg(F.first("answer"))
    )


def classify(df: DataFrame, strategy: str, **kw):
    """Refuse input without ``summary``, then one strategy over the
    prepared rows; returns what the strategy returns (see ``classify_job``)."""
    if "summary" not in df.columns:
        raise ValueError("input has no 'summary' column: summarise first")
    if strategy == "open_vocab":
        return classify_open_vocab(df, **kw)
    if strategy == "goals":
        return classify_goals(df, **kw), None
    if strategy == "batch":
        from tessera.plans.batch import classify_batch

        return classify_batch(df, **kw)
    raise ValueError(f"unknown strategy {strategy!r}")


def classify_job(df: DataFrame, strategy: str, out_path: str, run_id: str, sort_by: str = "created_at",
                 limit: int | None = None, **kw) -> None:
    """E4 with its input step and sink: E2 -> refusal -> strategy -> S7. The
    topics (where the strategy has any) go to the stage beside the rows."""
    rows, topics = classify(prepare(df, sort_by, limit), strategy, **kw)
    write_stage(rows, out_path, run_id, "classified")
    if topics is not None:
        write_stage(topics, f"{out_path.rstrip('/')}-topics", run_id, "topics")
