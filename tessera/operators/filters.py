"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.jsonx import number
from tessera.schemas import README_MISSING, SUMMARY_ERROR, UNCATEGORIZED


def normalise_columns(df: DataFrame) -> DataFrame:
    """P5: ensure ``description``; rename ``readme_snippet`` to ``readme`` (if
    both exist keep ``readme``); ensure ``readme``."""
    cols = df.columns
    if "description" not in cols:
        df = df.withColumn("description", F.lit("").cast("string"))
    if "readme_snippet" in cols:
        if "readme" in cols:
            df = df.drop("readme_snippet")
        else:
            df = df.withColumnRenamed("readme_snippet", "readme")
    elif "readme" not in cols:
        df = df.withColumn("readme", F.lit("").cast("string"))
    return df


def pending(df: DataFrame, col: str = "summary", retry_errors: bool = False) -> DataFrame:
    """Rows still to process: null ``col``. Error sentinels are kept as
    done unless ``retry_errors``."""
    if col not in df.columns:
        return df
    cond = F.col(col).isNull()
    if retry_errors:
        cond = cond | (F.col(col) == F.lit(SUMMARY_ERROR))
    return df.filter(cond)


def done(df: DataFrame, col: str = "summary", retry_errors: bool = False) -> DataFrame:
    """Complement of :func:`pending`."""
    if col not in df.columns:
        return df.limit(0)
    cond = F.col(col).isNotNull()
    if retry_errors:
        cond = cond & (F.col(col) != F.lit(SUMMARY_ERROR))
    return df.filter(cond)


def pending_embeddings(df: DataFrame, text_col: str = "summary", vec_col: str = "embedding",
                       embed_errors: bool = True) -> DataFrame:
    """Summary present and embedding missing; error sentinels are
    embedded unless ``embed_errors=False``."""
    return df.filter(embedding_due(text_col, vec_col if vec_col in df.columns else None, embed_errors))


def embedding_due(text_col: str, vec_col: str | None, embed_errors: bool = True) -> F.Column:
    cond = F.col(text_col).isNotNull()
    if vec_col is not None:
        cond = cond & F.col(vec_col).isNull()
    if not embed_errors:
        cond = cond & (F.col(text_col) != F.lit(SUMMARY_ERROR))
    return cond


def scorable(col: str = "summary") -> F.Column:
    """Goal scoring skips null and error summaries (rows are kept)."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(SUMMARY_ERROR))


def missing_readme(df: DataFrame, col: str = "readme_snippet") -> DataFrame:
    """P10: rows whose README is the sentinel."""
    return df.filter(F.col(col).eqNullSafe(F.lit(README_MISSING)))


def drop_missing_readme(df: DataFrame, col: str = "readme_snippet") -> DataFrame:
    """P10: drop sentinel READMEs but keep nulls (plain ``<>`` loses them)."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(README_MISSING)))


def drop_uncategorized(df: DataFrame, col: str = "topic") -> DataFrame:
    """P11."""
    if col not in df.columns:
        return df
    return df.filter(~F.col(col).eqNullSafe(F.lit(UNCATEGORIZED)))


# Fill defaults for the topic report.
TEXT_FILL = {"description": "", "readme": "", "summary": "", "topic": ""}
LANGUAGE_FILL = "Unknown"


def fill_text(df: DataFrame, extra: Mapping[str, str] | None = None) -> DataFrame:
    """Description, readme, summary, topic -> empty; language -> Unknown
    (only for present columns)."""
    fills = {c: v for c, v in TEXT_FILL.items() if c in df.columns}
    if "language" in df.columns:
        fills["language"] = LANGUAGE_FILL
    if extra:
        fills.update({c: v for c, v in extra.items() if c in df.columns})
    return df.na.fill(fills) if fills else df


def to_score(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Coerce to number, failures (and NaN, which would rank first) to
    null."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: number(F.col(c).try_cast("string")) for c in present})


def nonempty_text(df: DataFrame, col: str) -> DataFrame:
    """Drop blank processed texts."""
    return df.filter(F.col(col).isNotNull() & (F.trim(F.col(col)) != ""))
