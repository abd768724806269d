"""Queries for batch inference and whole jobs (2.12), run with
the deterministic stub models so DuckDB can restate the expected output."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import stubs
from tessera.functions.prompts import goals_text, render_prompt
from tessera.operators.inference import predict_text
from tessera.plans import classify as C
from tessera.plans.reports import goal_report, reprocess
from tessera.plans.scan import scan
from tessera.plans.summarise import prepare, summarise
from tessera.queries.registry import query, ts, ts_sql
from tessera.queries.relational import (
    CLUSTERS_SQL,
    _md5_key_sql,
    _render_sql,
    _seeds_sql,
    _sql_str,
    clusters_standin,
)
from tessera.queries.views import (
    CATALOGUE_SQL,
    GOAL_NAMES,
    GOAL_SLUGS,
    SUMMARISED_SQL,
    TOKEN_RE,
    all_words_sql,
    summarised,
    topic_case_sql,
    with_,
)
from tessera.schemas import GOAL_MISSING_REASON, SUMMARY_ERROR
from tessera.session import shared_path
from tessera.sources import standins

KEY = ["account", "name"]
PROMPT_SQL = _render_sql(stubs.SUMMARY_TEMPLATE, {"description": "description", "readme": "readme"})
NORMALISED_SQL = CATALOGUE_SQL + """,
normalised AS (SELECT account, name, description, stars, forks, language, url, readme_snippet AS readme,
                      last_scanned_utc, created_at, pushed_at, doc_id FROM catalogue)"""


@query("predict_text", with_(NORMALISED_SQL, f"SELECT account, name, {all_words_sql(PROMPT_SQL)} AS summary FROM normalised"))
def q_predict_text(spark, sf_dir):
    cat = prepare(standins.catalogue(spark, sf_dir))
    out = predict_text(cat, render_prompt(stubs.SUMMARY_TEMPLATE), stubs.first_words(None))
    return out.select(*KEY, "summary")


@query(
    "on_error",
    with_(
        NORMALISED_SQL,
        f"""SELECT account, name,
  CASE WHEN length({PROMPT_SQL}) % 11 = 0 THEN '{SUMMARY_ERROR}' ELSE {all_words_sql(PROMPT_SQL)} END AS summary,
  length({PROMPT_SQL}) % 11 = 0 AS failed FROM normalised""",
    ),
)
def q_on_error(spark, sf_dir):
    cat = prepare(standins.catalogue(spark, sf_dir))
    out = predict_text(cat, render_prompt(stubs.SUMMARY_TEMPLATE), stubs.first_words(None, fail_mod=11),
                       error_col="error")
    return out.select(*KEY, "summary", F.col("error").isNotNull().alias("failed"))


@query(
    "summarise",
    with_(SUMMARISED_SQL, f"SELECT account, name, coalesce(summary, {all_words_sql(PROMPT_SQL)}) AS summary FROM summarised"),
)
def q_summarise(spark, sf_dir):
    out = summarise(summarised(spark, sf_dir), stubs.SUMMARY_TEMPLATE, stubs.first_words(None))
    return out.select(*KEY, "summary")


# The default waves over 1,000 rows: five, each twice the one before.
WAVES = [(0, 64), (64, 192), (192, 448), (448, 960), (960, 1984), (1984, 4032), (4032, 8128), (8128, None)]


def _open_vocab(spark, sf_dir):
    """Answers depend on the topics that the prompt lists."""
    return C.classify_open_vocab(summarised(spark, sf_dir), stubs.TOPIC_TEMPLATE, stubs.seed_topic(use_prompt_list=True),
                                 stubs.SEED_TOPICS)


def _wave_sql(k: int, lo: int, hi: int | None) -> str:
    """Wave k: answers from vocabulary k, then vocabulary k + 1."""
    until = f" AND ord <= {hi}" if hi is not None else ""
    return f"""
a{k} AS MATERIALIZED (
  SELECT o.account, o.name, o.ord, coalesce(arg_min(v.topic, v.rank), any_value(o.word)) AS topic
  FROM (SELECT * FROM ordered WHERE ord > {lo}{until}) o LEFT JOIN v{k} v ON contains(o.low, v.topic)
  GROUP BY o.account, o.name, o.ord),
v{k + 1} AS MATERIALIZED (
  SELECT topic, rank FROM v{k} UNION ALL
  SELECT topic, CAST((SELECT count(*) FROM v{k}) + row_number() OVER (ORDER BY first_seen, topic) - 1 AS INTEGER) AS rank
  FROM (SELECT topic, min(ord) AS first_seen FROM a{k} WHERE topic NOT IN (SELECT topic FROM v{k}) GROUP BY topic))"""


OPEN_VOCAB_SQL = SUMMARISED_SQL + ",\n" + _seeds_sql() + f""",
ordered AS MATERIALIZED (
  SELECT account, name, lower(coalesce(summary, '')) AS low,
         coalesce(lower(regexp_extract_all(coalesce(summary, ''), '{TOKEN_RE}')[1]), 'misc') AS word,
         row_number() OVER (ORDER BY created_at DESC NULLS LAST, account, name) AS ord FROM summarised),
v0 AS MATERIALIZED (SELECT topic, CAST(rank AS INTEGER) AS rank FROM seeds),""" + ",".join(
    _wave_sql(k, lo, hi) for k, (lo, hi) in enumerate(WAVES))


@query("classify_open_vocab", with_(OPEN_VOCAB_SQL, " UNION ALL ".join(f"SELECT account, name, topic FROM a{k}" for k in range(len(WAVES)))))
def q_classify_open_vocab(spark, sf_dir):
    out, _ = _open_vocab(spark, sf_dir)
    return out.select(*KEY, "topic")


@query("open_vocab_topics", with_(OPEN_VOCAB_SQL, f"SELECT topic, rank FROM v{len(WAVES)}"))
def q_open_vocab_topics(spark, sf_dir):
    _, vocab = _open_vocab(spark, sf_dir)
    return vocab


LABEL_SQL = SUMMARISED_SQL + ",\n" + CLUSTERS_SQL + f""",
joined AS (SELECT s.account, s.name, s.summary, c.cluster_id FROM summarised s JOIN clusters c ON c.vec_id = s.doc_id
           WHERE c.cluster_id <> -1),
sampled AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY {_md5_key_sql(42)}, account, name) AS sample_rank
            FROM joined QUALIFY sample_rank <= 5),
groups AS (SELECT cluster_id, string_agg(summary, chr(10) || '- ' ORDER BY sample_rank) AS summaries FROM sampled GROUP BY cluster_id)"""


@query(
    "label_clusters",
    with_(
        LABEL_SQL,
        f"""SELECT cluster_id, 'Group ' || coalesce(lower(regexp_extract_all(split_part(coalesce(summaries, ''), chr(10), 1),
  '{TOKEN_RE}')[1]), 'none') AS label FROM groups""",
    ),
)
def q_label_clusters(spark, sf_dir):
    s = summarised(spark, sf_dir, keep_doc_id=True)
    cl = clusters_standin(spark, sf_dir)
    j = s.join(cl, s.doc_id == cl.vec_id).select(*KEY, "summary", "cluster_id")
    return C.label_clusters(j, stubs.LABEL_TEMPLATE, stubs.cluster_label())


GOAL_PROMPT_SQL = _render_sql(stubs.GOAL_TEMPLATE, {"summary": "summary", "goals_formatted": _sql_str(goals_text(stubs.GOALS))})


def _goal_answer_cols_sql(n: str = "n") -> str:
    cols = []
    g = len(GOAL_NAMES)
    for i, s in enumerate(GOAL_SLUGS):
        present = f"(NOT ({n} % 13 = 0) AND NOT ({n} % 9 = 0) AND NOT ({n} % 4 = 0 AND {n} % {g} = {i}))"
        cols.append(f"CASE WHEN NOT ok THEN NULL WHEN {present} THEN CAST(({n} + {i}) % 6 AS DOUBLE) ELSE 0.0 END AS {s}_score")
        cols.append(
            f"CASE WHEN NOT ok THEN NULL WHEN {present} THEN 'r' || CAST(({n} + {i}) % 6 AS VARCHAR) ELSE '{GOAL_MISSING_REASON}' END AS {s}_reason"
        )
    return ",\n  ".join(cols)


GOALS_SQL = SUMMARISED_SQL + f""",
gp AS (SELECT account, name, created_at, summary, coalesce(summary IS NOT NULL AND summary <> '{SUMMARY_ERROR}', false) AS ok,
              length({GOAL_PROMPT_SQL}) AS n FROM summarised),
goals_out AS (SELECT account, name, created_at, summary, {_goal_answer_cols_sql()} FROM gp)"""
GOAL_COLS = [f"{s}_{k}" for s in GOAL_SLUGS for k in ("score", "reason")]


def _classified_goals(spark, sf_dir):
    return C.classify_goals(summarised(spark, sf_dir), stubs.GOAL_TEMPLATE, stubs.GOALS,
                            stubs.goal_answer(GOAL_NAMES))


@query("classify_goals", with_(GOALS_SQL, f"SELECT account, name, {', '.join(GOAL_COLS)} FROM goals_out"))
def q_classify_goals(spark, sf_dir):
    return _classified_goals(spark, sf_dir).select(*KEY, *GOAL_COLS)


@query("classify", with_(GOALS_SQL, f"SELECT account, name, {', '.join(GOAL_COLS)} FROM goals_out"))
def q_classify(spark, sf_dir):
    """E4 (goal strategy) over the prepared catalogue."""
    df = prepare(summarised(spark, sf_dir))
    out, _ = C.classify(df, "goals", template=stubs.GOAL_TEMPLATE, goals=stubs.GOALS,
                        factory=stubs.goal_answer(GOAL_NAMES))
    return out.select(*KEY, *GOAL_COLS)


def _long_goals_sql() -> str:
    return "\nUNION ALL\n".join(f"SELECT '{s}' AS goal, {s}_score AS score FROM goals_out" for s in GOAL_SLUGS)


@query(
    "goal_report",
    with_(
        GOALS_SQL + f",\nlong AS ({_long_goals_sql()}),\ngrid AS (SELECT goal, score_bin FROM (VALUES "
        + ", ".join(f"('{s}')" for s in GOAL_SLUGS) + ") g(goal), range(0, 6) r(score_bin))",
        """SELECT g.goal, CAST(g.score_bin AS INTEGER) AS score_bin, CAST(count(l.score) AS BIGINT) AS "count"
FROM grid g LEFT JOIN long l ON l.goal = g.goal AND CAST(floor(l.score) AS BIGINT) = g.score_bin
GROUP BY g.goal, g.score_bin""",
    ),
)
def q_goal_report(spark, sf_dir):
    """E6 over model-scored rows: the histogram frame (W1 and T4 frames are
    checked through ``top_per_goal`` and ``high_impact``)."""
    return goal_report(_classified_goals(spark, sf_dir), GOAL_SLUGS)["histogram"]


@query(
    "compare_prompts",
    with_(
        SUMMARISED_SQL + f""",
smp AS (SELECT * FROM summarised ORDER BY {_md5_key_sql(62)}, account, name LIMIT 10)""",
        "SELECT account, name, description, summary AS original_summary, "
        + ", ".join(
            f"{all_words_sql(_render_sql(p['template'], {'description': 'description', 'readme': 'readme'}))} AS {p['prompt_name']}"
            for p in stubs.PROMPTS
        )
        + " FROM smp",
    ),
)
def q_compare_prompts(spark, sf_dir):
    return C.compare_prompts(summarised(spark, sf_dir), stubs.PROMPTS, stubs.first_words(None))


# ------------------------------------------------------------------ jobs
SCANNED_SQL = """SELECT source AS account, 'doc-' || CAST(doc_id AS VARCHAR) AS name,
  CASE WHEN lang IN ('de', 'fr') THEN 'No description'
       ELSE coalesce(nullif(split_part(text, chr(10), 1), ''), 'No description') END AS description,
  CAST(CASE WHEN lang = 'es' THEN 0 WHEN lang = 'fr' THEN NULL ELSE n_chars END AS DOUBLE) AS stars,
  CAST(CASE WHEN lang = 'es' THEN 0 WHEN lang = 'fr' THEN NULL
       ELSE length(text) - length(replace(text, chr(10), '')) END AS DOUBLE) AS forks,
  CASE WHEN lang = 'de' THEN 'None specified' ELSE lang END AS language,
  CASE WHEN lang = 'es' THEN '' ELSE 'https://example.org/' || source || '/doc-' || CAST(doc_id AS VARCHAR) END AS url,
  CASE WHEN doc_id % 7 = 0 THEN 'README not available' ELSE substr(text, 1, 800) END AS readme_snippet,
  '2024-06-01 00:00:00' AS last_scanned_utc,
  strftime(CAST(DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created_at,
  CAST(NULL AS VARCHAR) AS pushed_at
FROM documents c WHERE n_chars >= 50
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.doc_id AND l.quality <> 0)"""


def scan_registry(spark, sf_dir):
    """Registry of listing accounts: languages as groups, sources as
    accounts (bounded by the number of accounts)."""
    d = standins.table(spark, sf_dir, "documents")
    return d.groupBy(F.col("lang").alias("group")).agg(F.array_sort(F.collect_set("source")).alias("accounts"))


@query("scan", SCANNED_SQL)
def q_scan(spark, sf_dir):
    """E1 end to end over landed responses; stored catalogue = labelled rows
    (quality-0 rows stored with an empty name, so they are scanned again)."""
    lab = standins.table(spark, sf_dir, "labels")
    stored = (
        standins.catalogue(spark, sf_dir)
        .withColumn("doc_id", F.substring_index("name", "-", -1).cast("bigint"))
        .join(lab, "doc_id")
        .withColumn("name", F.when(F.col("quality") == 0, F.lit("")).otherwise(F.col("name")))
        .drop("doc_id", "quality", "toxic")
    )
    rows = scan(scan_registry(spark, sf_dir), standins.listing_responses(spark, sf_dir),
                standins.readme_responses(spark, sf_dir), stored,
                scan_time=F.lit(standins.SCAN_STAMP).cast("timestamp"))
    out = rows.withColumns({c: ts(c) for c in ["last_scanned_utc", "created_at", "pushed_at"]})
    return out.withColumns({c: F.col(c).cast("double") for c in ["stars", "forks"]})


@query(
    "prepare",
    with_(
        CATALOGUE_SQL,
        f"""SELECT account, name, description, stars, forks, language, url, readme_snippet AS readme,
  {ts_sql('last_scanned_utc')} AS last_scanned_utc, {ts_sql('created_at')} AS created_at, {ts_sql('pushed_at')} AS pushed_at
FROM catalogue""",
    ),
)
def q_prepare(spark, sf_dir):
    p = prepare(standins.catalogue(spark, sf_dir), "created_at", None)
    return p.withColumns({c: ts(c) for c in ["last_scanned_utc", "created_at", "pushed_at"]})


@query(
    "reprocess",
    """SELECT CAST(count(*) AS BIGINT) AS before, CAST(count(*) FILTER (WHERE doc_id % 7 <> 0) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE doc_id % 7 <> 0) AS BIGINT) AS after, CAST(0 AS BIGINT) AS remaining_rejected,
  CAST(count(*) FILTER (WHERE doc_id % 7 = 0) AS BIGINT) AS missing
FROM documents""",
)
def q_reprocess(spark, sf_dir):
    """Write the README-attached catalogue to the shared folder, audit it,
    rewrite it without sentinel rows and verify by reloading."""
    from tessera.queries.relational import readme_attached

    path = shared_path(spark, "catalogue")
    readme_attached(spark, sf_dir).write.parquet(path)
    audit = reprocess(spark, path)
    r = audit["rewrite"] or {"before": 0, "kept": 0, "after": 0, "remaining_rejected": 0}
    row = (r["before"], r["kept"], r["after"], r["remaining_rejected"], audit["missing"]["missing"])
    return spark.createDataFrame([row], "before bigint, kept bigint, after bigint, remaining_rejected bigint, missing bigint")
