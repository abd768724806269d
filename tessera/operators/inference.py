"""Batch inference as DataFrame operators (M1, M2, M5).

The model is a caller-supplied *factory* (picklable, no arguments) that
returns the model function; it is built once per task on the executors,
and its calls run inside an Arrow-batched iterator UDF. Texts stay in Arrow but
for the one that the model reads, and answers leave a task in small pieces, so
a worker's memory is a batch (at most Spark's limit of bytes) and a piece,
however many rows there are. Pending rows
are filtered before the UDF, so done work never reaches Python. The UDF is
non-deterministic by default: Catalyst then never duplicates or reorders
the call, and callers persist or write the result before reusing it."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import EMBED_BATCH, SUMMARY_ERROR

RESULT = T.StructType([T.StructField("value", T.StringType()), T.StructField("error", T.StringType())])
#: Answers sent on at once: so many rows or characters.
PIECE_ROWS, PIECE_CHARS = 1024, 1 << 20

_MODELS: dict[str, Callable] = {}


def build(factory: Callable[[], Callable]) -> Callable:
    key = getattr(factory, "cache_key", None)
    if key is None:
        return factory()
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]


def text_model_udf(factory: Callable[[], Callable[[str], str]], on_error: str = "sentinel",
                   error_value: str | None = SUMMARY_ERROR, pause_s: float = 0.0,
                   deterministic: bool = False):
    """M1 + M2 as an Arrow UDF returning ``struct<value, error>``.

    ``on_error``: ``"sentinel"`` -> value = ``error_value``, job goes on;
    ``"raise"`` -> the task fails (topic and label calls). ``pause_s`` is the
    pause after each call inside a task (0 = none)."""
    if on_error not in ("sentinel", "raise"):
        raise ValueError(f"on_error must be 'sentinel' or 'raise', not {on_error!r}")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = build(factory)
        for prompts in batches:
            yield from answers(model, prompts)

    def answers(model, prompts: pa.Array) -> Iterator[pa.Array]:
        values, errors, chars = [], [], 0
        for text in prompts:
            value = error = None
            if text.is_valid:  # else a row that is not due
                try:
                    value = model(text.as_py())
                except Exception as e:  # noqa: BLE001 - policy decides
                    if on_error == "raise":
                        raise
                    value, error = error_value, f"{type(e).__name__}: {e}"
                if pause_s > 0:
                    time.sleep(pause_s)
            values.append(value)
            errors.append(error)
            chars += len(value or "")
            if len(values) >= PIECE_ROWS or chars >= PIECE_CHARS:
                yield _answers(values, errors)
                values, errors, chars = [], [], 0
        if values:
            yield _answers(values, errors)

    udf = F.arrow_udf(run, RESULT)
    return udf if deterministic else udf.asNondeterministic()


def _answers(values: list, errors: list) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(values, pa.string()), pa.array(errors, pa.string())], names=["value", "error"])


def predict_text(df: DataFrame, prompt: Column, factory, out_col: str = "summary", error_col: str | None = None,
                 tasks: int | None = None, **kw) -> DataFrame:
    """M1: one model call per row of ``df`` whose prompt is not null.

    ``tasks``: run the calls in so many tasks, which with ``pause_s`` fixes the
    overall rate at tasks / pause."""
    if tasks:
        df = df.repartition(tasks)
    r = text_model_udf(factory, **kw)(prompt)
    out = df.withColumn("__r", r).withColumn(out_col, F.col("__r.value"))
    if error_col:
        out = out.withColumn(error_col, F.col("__r.error"))
    return out.drop("__r")


def embedding_udf(factory: Callable[[], Callable[[list[str]], list[list[float]]]],
                  batch_size: int = EMBED_BATCH, deterministic: bool = False, pause_s: float = 0.0):
    """M5: model called on batches of ``batch_size`` texts, vectors out as
    ``ARRAY<FLOAT>``. Null texts are not sent and stay null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = build(factory)
        for s in batches:
            due = [i for i, t in enumerate(s) if t is not None]
            out: list = [None] * len(s)
            for k in range(0, len(due), batch_size):
                part = due[k : k + batch_size]
                for i, vector in zip(part, model([s.iloc[i] for i in part]), strict=True):
                    out[i] = vector
                if pause_s > 0:
                    time.sleep(pause_s)
            yield pd.Series(out, dtype=object)

    udf = F.pandas_udf(run, T.ArrayType(T.FloatType()))
    return udf if deterministic else udf.asNondeterministic()


def embed(df: DataFrame, factory, text_col: str = "summary", out_col: str = "embedding",
          batch_size: int = EMBED_BATCH, **kw) -> DataFrame:
    """M5 over pending rows (see ``filters.pending_embeddings``)."""
    return df.withColumn(out_col, embedding_udf(factory, batch_size, **kw)(F.col(text_col)))
