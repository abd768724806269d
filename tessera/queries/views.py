"""DuckDB twins of the Spark stand-ins, as CTE text for the oracle SQL,
plus the matching Spark builders for derived stand-ins (summaries, topics,
goal scores) that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.jsonx import extract_json, goal_map, goal_score_columns
from tessera.operators.filters import normalise_columns, scorable
from tessera.schemas import SUMMARY_ERROR, UNCATEGORIZED
from tessera.sources import standins
from tessera.stubs import GOALS, SEED_TOPICS

TOKEN_RE = r"[^ \t\n\r]+"
GOAL_NAMES = [g["name"] for g in GOALS]
GOAL_SLUGS = [g.replace(" ", "_").lower() for g in GOAL_NAMES]

# ---------------------------------------------------------------- DuckDB
CATALOGUE_SQL = """catalogue AS (
  SELECT source AS account, 'doc-' || CAST(doc_id AS VARCHAR) AS name,
         split_part(text, chr(10), 1) AS description,
         n_chars AS stars,
         CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS forks,
         lang AS language,
         'https://example.org/' || source || '/doc-' || CAST(doc_id AS VARCHAR) AS url,
         text AS readme_snippet,
         TIMESTAMP '2024-06-01 00:00:00' AS last_scanned_utc,
         CAST(DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS TIMESTAMP)
           + to_days(CAST(n_chars % 365 AS INTEGER)) AS pushed_at,
         doc_id
  FROM documents)"""


def all_words_sql(expr: str) -> str:
    return f"array_to_string(regexp_extract_all({expr}, '{TOKEN_RE}'), ' ')"


SUMMARISED_SQL = CATALOGUE_SQL + f""",
summarised AS (
  SELECT c.account, c.name, c.description, c.stars, c.forks, c.language, c.url,
         c.readme_snippet AS readme, c.last_scanned_utc, c.created_at, c.pushed_at,
         CASE WHEN c.stars < 30 THEN NULL
              WHEN l.toxic = 1 THEN '{SUMMARY_ERROR}'
              ELSE {all_words_sql('c.readme_snippet')} END AS summary,
         c.doc_id
  FROM catalogue c LEFT JOIN labels l ON l.doc_id = c.doc_id)"""


def topic_case_sql(summary: str) -> str:
    whens = " ".join(f"WHEN contains(lower({summary}), '{t}') THEN '{t}'" for t in SEED_TOPICS)
    first = f"lower(regexp_extract_all({summary}, '{TOKEN_RE}')[1])"
    return f"CASE {whens} ELSE coalesce({first}, 'misc') END"


CLASSIFIED_SQL = SUMMARISED_SQL + f""",
classified AS (
  SELECT s.*, CASE WHEN s.summary IS NULL THEN '{UNCATEGORIZED}'
                   ELSE {topic_case_sql('s.summary')} END AS topic
  FROM summarised s)"""


def _goal_cols_sql() -> str:
    miss = "'Evaluation missing from LLM output.'"
    ok = f"(s.summary IS NOT NULL AND s.summary <> '{SUMMARY_ERROR}')"
    lab = "l.quality IS NOT NULL"
    s0, s1, s2, s3, s4 = GOAL_SLUGS
    cols = [
        f"CASE WHEN NOT {ok} THEN NULL WHEN {lab} THEN CAST(l.quality * 5 AS DOUBLE) ELSE 0.0 END AS {s0}_score",
        f"CASE WHEN NOT {ok} THEN NULL WHEN {lab} THEN 'quality ' || CAST(l.quality AS VARCHAR) ELSE {miss} END AS {s0}_reason",
        f"CASE WHEN NOT {ok} THEN NULL WHEN {lab} THEN CAST(l.toxic + 1 AS DOUBLE) ELSE 0.0 END AS {s1}_score",
        f"CASE WHEN NOT {ok} THEN NULL WHEN {lab} THEN NULL ELSE {miss} END AS {s1}_reason",
        f"CASE WHEN NOT {ok} THEN NULL WHEN {lab} AND l.toxic = 1 THEN NULL WHEN {lab} THEN 2.5 ELSE 0.0 END AS {s2}_score",
        f"CASE WHEN NOT {ok} THEN NULL WHEN {lab} AND l.toxic = 1 THEN NULL WHEN {lab} THEN 'half' ELSE {miss} END AS {s2}_reason",
        f"CASE WHEN NOT {ok} THEN NULL ELSE 0.0 END AS {s3}_score",
        f"CASE WHEN NOT {ok} THEN NULL ELSE {miss} END AS {s3}_reason",
        f"CASE WHEN NOT {ok} THEN NULL ELSE 0.0 END AS {s4}_score",
        f"CASE WHEN NOT {ok} THEN NULL ELSE {miss} END AS {s4}_reason",
    ]
    return ",\n         ".join(cols)


GOAL_SCORED_SQL = SUMMARISED_SQL + f""",
goal_scored AS (
  SELECT s.*, {_goal_cols_sql()}
  FROM summarised s LEFT JOIN labels l ON l.doc_id = s.doc_id)"""


def with_(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


# ----------------------------------------------------------------- Spark
def all_words(col):
    return F.array_join(F.regexp_extract_all(col, F.lit(TOKEN_RE), 0), " ")


def _docs_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = standins.catalogue(spark, sf_dir).withColumn(
        "doc_id", F.substring_index("name", "-", -1).cast("bigint")
    )
    lab = standins.table(spark, sf_dir, "labels")
    return cat.join(lab, "doc_id", "left")


def summarised(spark: SparkSession, sf_dir: str, keep_doc_id: bool = False, keep_labels: bool = False) -> DataFrame:
    """Catalogue after a summary run: short texts were never summarised
    (null), toxic-labelled rows failed (error sentinel), the rest hold all words
    of their README, so that what follows works on whole texts."""
    j = normalise_columns(_docs_labels(spark, sf_dir))
    summary = (
        F.when(F.col("stars") < 30, F.lit(None).cast("string"))
        .when(F.col("toxic") == 1, F.lit(SUMMARY_ERROR))
        .otherwise(all_words(F.col("readme")))
    )
    out = j.withColumn("summary", summary)
    if not keep_labels:
        out = out.drop("quality", "toxic")
    return out if keep_doc_id else out.drop("doc_id")


def topic_expr(summary_col: str = "summary"):
    s = F.col(summary_col)
    low = F.lower(s)
    expr = None
    for t in SEED_TOPICS:
        cond = F.contains(low, F.lit(t))
        expr = F.when(cond, F.lit(t)) if expr is None else expr.when(cond, F.lit(t))
    first = F.lower(F.get(F.regexp_extract_all(s, F.lit(TOKEN_RE), 0), 0))
    return expr.otherwise(F.coalesce(first, F.lit("misc")))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = summarised(spark, sf_dir)
    return s.withColumn(
        "topic", F.when(F.col("summary").isNull(), F.lit(UNCATEGORIZED)).otherwise(topic_expr("summary"))
    )


def goal_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summarised rows with goal columns parsed from the stand-in answers;
    rows that are not scorable keep null scores (P9)."""
    s = summarised(spark, sf_dir, keep_labels=True)
    base = [c for c in s.columns if c not in ("quality", "toxic")]
    # The answer comes from the same row (one scan, no join back by key).
    m = goal_map(extract_json(standins.goal_answer_text(GOAL_NAMES, "language")))
    cols = goal_score_columns(m, GOAL_NAMES)
    ok = scorable("summary")
    return s.select(*base, *[F.when(ok, c).alias(name) for name, c in cols.items()])
