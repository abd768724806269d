"""Sorts, limits and top-k (T1-T6). A sort only ever comes right before a
limit, so Spark plans ``TakeOrderedAndProject`` (per-partition top-n, then
a merge of n rows per partition) instead of a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregates import total_score, value_counts
from tessera.operators.windows import hash_order
from tessera.schemas import KEY


def _order(df: DataFrame, by: str | None) -> list:
    out = []
    if by and by in df.columns:
        out.append(F.desc_nulls_last(by))
    out += [F.asc(k) for k in KEY if k in df.columns]
    return out


def limit_top(df: DataFrame, n: int | None, by: str | None = "created_at") -> DataFrame:
    """T1 + T2: the first n rows by ``by`` descending (nulls last, key as
    tie-break). A null, zero or negative n means no limit and no sort; a
    missing ``by`` column means key order only."""
    if n is None or n <= 0:
        return df
    return df.orderBy(*_order(df, by)).limit(n)


def sort_desc(df: DataFrame, by: str) -> DataFrame:
    """T1 for display: descending, nulls last, key tie-break."""
    if by not in df.columns:
        return df
    return df.orderBy(*_order(df, by))


def top_values(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """The n most frequent values, ties by value."""
    return value_counts(df, col).orderBy(F.desc("count"), F.asc(col)).limit(n)


def high_impact(df: DataFrame, score_cols: Sequence[str], n: int = 10,
                cols: Sequence[str] = ("name", "summary")) -> DataFrame:
    """T4: the n largest total scores with their score columns."""
    keep = [c for c in dict.fromkeys([*KEY, *cols]) if c in df.columns]
    scored = df.select(*keep, *score_cols, total_score(score_cols).alias("total_score"))
    return scored.orderBy(F.desc("total_score"), *[F.asc(k) for k in KEY]).limit(n)


def sample_rows(df: DataFrame, n: int = 10, seed: int = 62, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """T5: reproducible sample of min(n, rows) rows (hash order)."""
    return df.orderBy(hash_order(seed, keys), *[F.asc(k) for k in keys]).limit(n)


def cluster_sizes(df: DataFrame, col: str = "text_cluster") -> DataFrame:
    """Rows per cluster (id order is applied at output)."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
