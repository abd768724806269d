"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import cut_lineage

__all__ = ["documents", "cut_lineage", "word_count", "per_batch", "sql_schema", "temporary"]

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def temporary(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sql_schema(df: DataFrame, *fields: tuple[str, str]) -> T.StructType:
    """The schema of ``df`` with more fields behind it."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T._parse_datatype_string(t)) for n, t in fields)])


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema) -> DataFrame:
    """Apply a function on Arrow batches; ``make`` builds it once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            yield from work(batch)

    return df.mapInArrow(run, schema)
