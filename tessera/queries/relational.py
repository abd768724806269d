"""Queries for sources, projections, joins, aggregations, windows, top-k,
set operations and scalar functions (SURVEY 2.1-2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import jsonx, prompts
from tessera.functions import text as tx
from tessera.operators import aggregates as A
from tessera.operators import filters as P
from tessera.operators import joins as J
from tessera.operators import sets as U
from tessera.operators import topk as T
from tessera.operators import windows as W
from tessera.queries.registry import query, r6, ts, ts_sql
from tessera.queries.views import (
    CATALOGUE_SQL,
    CLASSIFIED_SQL,
    GOAL_NAMES,
    GOAL_SCORED_SQL,
    GOAL_SLUGS,
    SUMMARISED_SQL,
    TOKEN_RE,
    classified,
    all_words,
    all_words_sql,
    goal_scored,
    summarised,
    with_,
)
from tessera.schemas import README_MISSING, UNCATEGORIZED
from tessera.session import shared_path
from tessera.sources import ingest, standins
from tessera.stubs import GOAL_TEMPLATE, GOALS, SEED_TOPICS, SUMMARY_TEMPLATE, TOPIC_TEMPLATE

KEY = ["account", "name"]
# Fixed values (our own): the allow list used by the registry queries.
ALLOWED = [f"Customer#{k:09d}" for k in (1, 3, 7, 12, 24, 99, 10**9)]
ALLOWED_SQL = ", ".join(f"'{a}'" for a in ALLOWED)

REGISTRY_SQL = """registry AS (SELECT c_mktsegment || ' ' || CAST(c_custkey // 100 AS VARCHAR) AS "group", c_name AS account FROM customer)"""


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------ 2.1 sources
def landed_registry(spark, sf_dir):
    """Land the registry stand-in as JSON mappings, one for each group, then
    read them back through S1."""
    reg = standins.registry(spark, sf_dir)
    path = shared_path(spark, "registry")
    reg.select(F.to_json(F.create_map("group", "accounts")).alias("value")).write.text(path)
    return ingest.read_registry(spark, path, lines=True)


@query(
    "read_registry",
    with_(REGISTRY_SQL, """SELECT "group", string_agg(account, ',' ORDER BY account) AS accounts FROM registry GROUP BY "group\""""),
)
def q_read_registry(spark, sf_dir):
    return landed_registry(spark, sf_dir).select("group", F.array_join("accounts", ",").alias("accounts"))


@query("flatten_registry", with_(REGISTRY_SQL, 'SELECT DISTINCT "group", account FROM registry'))
def q_flatten_registry(spark, sf_dir):
    return ingest.flatten_registry(landed_registry(spark, sf_dir)).distinct()


@query("allow_list", f"SELECT DISTINCT c_name AS account FROM customer WHERE c_name IN ({ALLOWED_SQL})")
def q_allow_list(spark, sf_dir):
    return ingest.account_names(standins.registry(spark, sf_dir), ALLOWED)


LISTING_SQL = """listing AS (
  SELECT source AS account, doc_id // 100 AS page,
         CAST(row_number() OVER (PARTITION BY source, doc_id // 100 ORDER BY doc_id) - 1 AS INTEGER) AS pos,
         CASE WHEN n_chars < 50 THEN '' ELSE 'doc-' || CAST(doc_id AS VARCHAR) END AS item_name,
         doc_id, n_chars, lang, source, text
  FROM documents)"""


def landed_listing(spark, sf_dir):
    path = shared_path(spark, "listing")
    standins.listing_responses(spark, sf_dir).write.json(path)
    return ingest.read_listing(spark, path)


@query("read_listing", with_(LISTING_SQL, "SELECT account, page, pos, item_name FROM listing"))
def q_read_listing(spark, sf_dir):
    items = landed_listing(spark, sf_dir)
    return items.select("account", "page", "pos", F.get_json_object("item", "$.name").alias("item_name"))


# Every page also holds one non-object item after its documents; the page
# cap counts it.
ALL_ITEMS_SQL = LISTING_SQL + """,
all_items AS (
  SELECT account, page, pos, item_name, true AS is_object FROM listing
  UNION ALL
  SELECT account, page, CAST(count(*) AS INTEGER) AS pos, NULL AS item_name, false AS is_object
  FROM listing GROUP BY account, page)"""


@query(
    "cap_per_account",
    with_(
        ALL_ITEMS_SQL,
        """SELECT account, page, pos, item_name FROM all_items
QUALIFY row_number() OVER (PARTITION BY account ORDER BY page, pos) <= 30 AND is_object""",
    ),
)
def q_cap_per_account(spark, sf_dir):
    items = ingest.explode_listing(standins.listing_responses(spark, sf_dir), objects_only=False)
    capped = ingest.only_objects(ingest.cap_per_account(items, 30))
    return capped.select("account", "page", "pos", F.get_json_object("item", "$.name").alias("item_name"))


@query(
    "to_catalogue",
    """SELECT source AS account, 'doc-' || CAST(doc_id AS VARCHAR) AS name,
  CASE WHEN lang IN ('de', 'fr') THEN 'No description'
       ELSE coalesce(nullif(split_part(text, chr(10), 1), ''), 'No description') END AS description,
  CAST(CASE WHEN lang = 'es' THEN 0 WHEN lang = 'fr' THEN NULL ELSE n_chars END AS DOUBLE) AS stars,
  CAST(CASE WHEN lang = 'es' THEN 0 WHEN lang = 'fr' THEN NULL
       ELSE length(text) - length(replace(text, chr(10), '')) END AS DOUBLE) AS forks,
  CASE WHEN lang = 'de' THEN 'None specified' ELSE lang END AS language,
  CASE WHEN lang = 'es' THEN '' ELSE 'https://example.org/' || source || '/doc-' || CAST(doc_id AS VARCHAR) END AS url,
  'README not available' AS readme_snippet,
  '2024-06-01 00:00:00' AS last_scanned_utc,
  strftime(CAST(DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created_at,
  CAST(NULL AS VARCHAR) AS pushed_at
FROM documents WHERE n_chars >= 50""",
)
def q_to_catalogue(spark, sf_dir):
    items = ingest.explode_listing(standins.listing_responses(spark, sf_dir))
    cat = ingest.project_catalogue(ingest.to_catalogue(items, F.lit(standins.SCAN_STAMP).cast("timestamp")))
    # Nullable counts leave as DOUBLE so both engines hand over the same type.
    out = cat.withColumns({c: ts(c) for c in ["last_scanned_utc", "created_at", "pushed_at"]})
    return out.withColumns({c: F.col(c).cast("double") for c in ["stars", "forks"]})


@query("truncate_readme", "SELECT source AS account, 'doc-' || CAST(doc_id AS VARCHAR) AS name, substr(text, 1, 800) AS readme_snippet FROM documents")
def q_truncate_readme(spark, sf_dir):
    d = standins.table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("account"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
        tx.truncate_readme("text").alias("readme_snippet"),
    )


def readme_attached(spark, sf_dir):
    cat = standins.catalogue(spark, sf_dir).drop("readme_snippet")
    return J.attach_readme(cat, standins.readme_responses(spark, sf_dir))


ATTACHED_SQL = """attached AS (
  SELECT source AS account, 'doc-' || CAST(doc_id AS VARCHAR) AS name, n_chars AS stars,
         CASE WHEN doc_id % 7 = 0 THEN 'README not available' ELSE substr(text, 1, 800) END AS readme_snippet
  FROM documents)"""


@query("attach_readme", with_(ATTACHED_SQL, "SELECT account, name, readme_snippet FROM attached"))
def q_attach_readme(spark, sf_dir):
    return readme_attached(spark, sf_dir).select("account", "name", "readme_snippet")


@query(
    "new_items",
    with_(
        LISTING_SQL,
        """SELECT account, item_name AS name, page, pos FROM listing
WHERE item_name <> '' AND NOT EXISTS (
  SELECT 1 FROM labels l WHERE l.doc_id = listing.doc_id AND l.quality <> 0)""",
    ),
)
def q_new_items(spark, sf_dir):
    items = ingest.explode_listing(standins.listing_responses(spark, sf_dir))
    named = items.select("account", "page", "pos", F.get_json_object("item", "$.name").alias("name")).filter(
        F.length("name") > 0
    )
    # The same listing seen again later in the run (a second scan pass).
    relisted = named.withColumn("page", F.col("page") + F.lit(1_000_000))
    listing = named.unionByName(relisted)
    # Stored catalogue: labelled documents; rows with quality 0 were stored
    # with an empty name and must be ignored as keys.
    lab = standins.table(spark, sf_dir, "labels")
    stored = (
        standins.catalogue(spark, sf_dir)
        .withColumn("doc_id", F.substring_index("name", "-", -1).cast("bigint"))
        .join(lab, "doc_id")
        .withColumn("name", F.when(F.col("quality") == 0, F.lit("")).otherwise(F.col("name")))
    )
    return J.new_items(listing, stored, order=("page", "pos")).select("account", "name", "page", "pos")


# ---------------------------------------------- 2.2 projections / filters
CAT_OUT_SQL = f"""SELECT account, name, description, stars, forks, language, url, readme_snippet AS readme,
  {ts_sql('last_scanned_utc')} AS last_scanned_utc, {ts_sql('created_at')} AS created_at,
  {ts_sql('pushed_at')} AS pushed_at FROM catalogue"""


def _ts_out(df):
    return df.withColumns({c: ts(c) for c in ["last_scanned_utc", "created_at", "pushed_at"] if c in df.columns})


@query("normalise_columns", with_(CATALOGUE_SQL, CAT_OUT_SQL))
def q_normalise_columns(spark, sf_dir):
    return _ts_out(P.normalise_columns(standins.catalogue(spark, sf_dir)))


@query("pending", with_(SUMMARISED_SQL, "SELECT account, name FROM summarised WHERE summary IS NULL"))
def q_pending(spark, sf_dir):
    return P.pending(summarised(spark, sf_dir)).select(*KEY)


def with_embeddings(spark, sf_dir):
    """Summarised rows; rows whose doc_id has a supplied vector were already
    embedded."""
    s = summarised(spark, sf_dir, keep_doc_id=True)
    v = standins.vectors(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), "embedding")
    return s.join(v, "doc_id", "left")


@query(
    "pending_embeddings",
    with_(
        SUMMARISED_SQL,
        """SELECT account, name FROM summarised s LEFT JOIN embeddings e ON e.vec_id = s.doc_id
WHERE s.summary IS NOT NULL AND e.embedding IS NULL""",
    ),
)
def q_pending_embeddings(spark, sf_dir):
    return P.pending_embeddings(with_embeddings(spark, sf_dir)).select(*KEY)


@query(
    "scorable",
    with_(
        SUMMARISED_SQL,
        "SELECT account, name, coalesce(summary IS NOT NULL AND summary <> 'Error generating summary.', false) AS scorable FROM summarised",
    ),
)
def q_scorable(spark, sf_dir):
    return summarised(spark, sf_dir).select(*KEY, F.coalesce(P.scorable(), F.lit(False)).alias("scorable"))


def readme_with_nulls(spark, sf_dir):
    """J3 output with null READMEs for the shortest texts."""
    a = readme_attached(spark, sf_dir)
    return a.withColumn("readme_snippet", F.when(F.col("stars") >= 30, F.col("readme_snippet")))


NULLED_SQL = ATTACHED_SQL + """,
nulled AS (SELECT account, name, CASE WHEN stars >= 30 THEN readme_snippet END AS readme_snippet FROM attached)"""


@query("missing_readme", with_(NULLED_SQL, f"SELECT account, name FROM nulled WHERE readme_snippet = '{README_MISSING}'"))
def q_missing_readme(spark, sf_dir):
    return P.missing_readme(readme_with_nulls(spark, sf_dir)).select(*KEY)


@query(
    "drop_missing_readme",
    with_(NULLED_SQL, f"SELECT account, name, readme_snippet FROM nulled WHERE readme_snippet IS DISTINCT FROM '{README_MISSING}'"),
)
def q_drop_missing_readme(spark, sf_dir):
    return P.drop_missing_readme(readme_with_nulls(spark, sf_dir)).select(*KEY, "readme_snippet")


@query("drop_uncategorized", with_(CLASSIFIED_SQL, f"SELECT account, name, topic FROM classified WHERE topic IS DISTINCT FROM '{UNCATEGORIZED}'"))
def q_drop_uncategorized(spark, sf_dir):
    return P.drop_uncategorized(classified(spark, sf_dir)).select(*KEY, "topic")


@query(
    "fill_text",
    with_(
        CLASSIFIED_SQL,
        """SELECT account, name, coalesce(description, '') AS description, coalesce(readme, '') AS readme,
  coalesce(summary, '') AS summary, coalesce(topic, '') AS topic,
  coalesce(CASE WHEN stars >= 40 THEN language END, 'Unknown') AS language FROM classified""",
    ),
)
def q_fill_text(spark, sf_dir):
    c = classified(spark, sf_dir).withColumn("language", F.when(F.col("stars") >= 40, F.col("language")))
    return P.fill_text(c).select(*KEY, "description", "readme", "summary", "topic", "language")


@query(
    "to_score",
    with_(
        GOAL_SCORED_SQL,
        f"""SELECT account, name, TRY_CAST(CAST({GOAL_SLUGS[0]}_score AS VARCHAR) AS DOUBLE) AS score_text,
  TRY_CAST({GOAL_SLUGS[0]}_reason AS DOUBLE) AS reason_text,
  TRY_CAST(CASE WHEN stars % 2 = 0 THEN CAST(stars AS VARCHAR) ELSE 'x' || CAST(stars AS VARCHAR) END AS DOUBLE) AS mixed
FROM goal_scored""",
    ),
)
def q_to_score(spark, sf_dir):
    g = goal_scored(spark, sf_dir)
    s0 = GOAL_SLUGS[0]
    t = g.select(
        *KEY,
        F.col(f"{s0}_score").cast("string").alias("score_text"),
        F.col(f"{s0}_reason").alias("reason_text"),
        F.when(F.col("stars") % 2 == 0, F.col("stars").cast("string"))
        .otherwise(F.concat(F.lit("x"), F.col("stars").cast("string")))
        .alias("mixed"),
    )
    return P.to_score(t, ["score_text", "reason_text", "mixed"])


def _stops_sql() -> str:
    return "[" + ", ".join(_sql_str(w) for w in tx.ENGLISH_STOP_WORDS) + "]"


def clean_text_sql(expr: str) -> str:
    spaced = f"regexp_replace(lower(coalesce({expr}, '')), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')"
    words = f"string_split_regex(trim({spaced}), ' +')"
    return (
        f"array_to_string(list_filter({words}, lambda w: length(w) >= 3 AND NOT list_contains({_stops_sql()}, w)), ' ')"
    )


@query(
    "nonempty_text",
    with_(
        SUMMARISED_SQL,
        f"""SELECT account, name, processed FROM (
  SELECT account, name, {clean_text_sql('summary')} AS processed FROM summarised)
WHERE processed IS NOT NULL AND trim(processed) <> ''""",
    ),
)
def q_nonempty_text(spark, sf_dir):
    s = summarised(spark, sf_dir).select(*KEY, tx.clean_text("summary").alias("processed"))
    return P.nonempty_text(s, "processed")


# ------------------------------------------------------------ 2.3 joins
@query(
    "assign_topic",
    with_(
        CLASSIFIED_SQL,
        f"""SELECT c.account, c.name, coalesce(k.topic, '{UNCATEGORIZED}') AS topic
FROM classified c LEFT JOIN (SELECT account, name, topic FROM classified WHERE stars >= 100) k
  ON k.account = c.account AND k.name = c.name""",
    ),
)
def q_assign_topic(spark, sf_dir):
    c = classified(spark, sf_dir)
    clustered = c.filter(F.col("stars") >= 100).select(*KEY, "topic")
    return J.assign_topic(c.select(*KEY, "topic"), clustered).select(*KEY, "topic")


CLUSTERS_SQL = """clusters AS (
  SELECT vec_id, CASE WHEN label = 0 THEN -1 ELSE label END AS cluster_id FROM embeddings)"""


def clusters_standin(spark, sf_dir):
    """Cluster assignment stand-in: the supplied vector labels, label 0 as
    the outlier group -1."""
    v = standins.vectors(spark, sf_dir)
    return v.select("vec_id", F.when(F.col("label") == 0, F.lit(-1)).otherwise(F.col("label")).alias("cluster_id"))


@query(
    "map_labels",
    with_(
        CLUSTERS_SQL,
        f"""SELECT vec_id, cluster_id, CASE WHEN cluster_id = -1 THEN '{UNCATEGORIZED}'
  WHEN cluster_id % 3 = 0 THEN '{UNCATEGORIZED}' ELSE 'label ' || CAST(cluster_id AS VARCHAR) END AS topic FROM clusters""",
    ),
)
def q_map_labels(spark, sf_dir):
    cl = clusters_standin(spark, sf_dir)
    labels = (
        cl.filter(F.col("cluster_id") != -1)
        .select("cluster_id")
        .distinct()
        .filter(F.col("cluster_id") % 3 != 0)  # clusters without a label fall back to Uncategorized
        .select("cluster_id", F.concat(F.lit("label "), F.col("cluster_id").cast("string")).alias("label"))
    )
    return J.map_labels(cl, labels).select("vec_id", "cluster_id", "topic")


@query(
    "attach_clusters",
    with_(
        SUMMARISED_SQL + ",\n" + CLUSTERS_SQL,
        """SELECT s.account, s.name, CAST(c.cluster_id AS DOUBLE) AS text_cluster
FROM summarised s LEFT JOIN clusters c ON c.vec_id = s.doc_id""",
    ),
)
def q_attach_clusters(spark, sf_dir):
    s = summarised(spark, sf_dir, keep_doc_id=True)
    cl = clusters_standin(spark, sf_dir)
    assigned = s.join(cl, s.doc_id == cl.vec_id).select(*KEY, F.col("cluster_id").alias("text_cluster"))
    out = J.attach_clusters(s.select(*KEY), assigned)
    return out.select(*KEY, F.col("text_cluster").cast("double").alias("text_cluster"))


def _prompts_values_sql() -> str:
    from tessera.stubs import PROMPTS

    rows = ", ".join(f"({_sql_str(p['prompt_name'])}, {_sql_str(p['template'])})" for p in PROMPTS)
    return f"prompts(prompt_name, template) AS (VALUES {rows})"


@query(
    "cross_prompts",
    with_(
        CATALOGUE_SQL + ",\n" + _prompts_values_sql(),
        "SELECT c.account, c.name, p.prompt_name, length(p.template) AS template_chars FROM catalogue c, prompts p",
    ),
)
def q_cross_prompts(spark, sf_dir):
    from tessera.stubs import PROMPTS

    c = standins.catalogue(spark, sf_dir).select(*KEY)
    return J.cross_prompts(c, PROMPTS).select(*KEY, "prompt_name", F.length("template").alias("template_chars"))


def _goals_values_sql() -> str:
    rows = ", ".join(f"({_sql_str(g['name'])}, {_sql_str(g['description'])})" for g in GOALS)
    return f"goals(goal, goal_description) AS (VALUES {rows})"


@query(
    "cross_goals",
    with_(
        SUMMARISED_SQL + ",\n" + _goals_values_sql(),
        """SELECT s.account, s.name, g.goal FROM summarised s, goals g
WHERE s.summary IS NOT NULL AND s.summary <> 'Error generating summary.'""",
    ),
)
def q_cross_goals(spark, sf_dir):
    s = summarised(spark, sf_dir).filter(P.scorable())
    return J.cross_goals(s.select(*KEY), GOALS).select(*KEY, "goal")


# ------------------------------------------------------ 2.4 aggregations
@query("value_counts", with_(CATALOGUE_SQL, 'SELECT language, count(*) AS "count" FROM catalogue WHERE language IS NOT NULL GROUP BY language'))
def q_value_counts(spark, sf_dir):
    return A.value_counts(standins.catalogue(spark, sf_dir), "language")


SUMMARISED_COLS = ["account", "name", "description", "stars", "forks", "language", "url", "readme",
                   "last_scanned_utc", "created_at", "pushed_at", "summary"]


@query(
    "null_profile",
    with_(
        SUMMARISED_SQL,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM summarised"
            for c in SUMMARISED_COLS
        ),
    ),
)
def q_null_profile(spark, sf_dir):
    return A.null_profile(summarised(spark, sf_dir).select(*SUMMARISED_COLS))


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS "count", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM catalogue"""


@query("describe_numeric", with_(CATALOGUE_SQL, "\nUNION ALL\n".join(_describe_sql(c) for c in ["stars", "forks"])))
def q_describe_numeric(spark, sf_dir):
    d = A.describe_numeric(standins.catalogue(spark, sf_dir), ["stars", "forks"])
    return d.select("column_name", "count", *[r6(c).alias(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


CATALOGUE_TYPES = [
    ("account", "string"), ("name", "string"), ("description", "string"), ("stars", "bigint"),
    ("forks", "bigint"), ("language", "string"), ("url", "string"), ("readme_snippet", "string"),
    ("last_scanned_utc", "timestamp"), ("created_at", "timestamp"), ("pushed_at", "timestamp"),
]


@query(
    "schema_profile",
    with_(
        CATALOGUE_SQL,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, count(*) AS row_count FROM catalogue"
            for c, t in CATALOGUE_TYPES
        ),
    ),
)
def q_schema_profile(spark, sf_dir):
    return A.schema_profile(standins.catalogue(spark, sf_dir))


@query(
    "missing_ratio",
    with_(
        ATTACHED_SQL,
        f"""SELECT count(*) FILTER (WHERE readme_snippet = '{README_MISSING}') AS missing, count(*) AS total,
  round(CAST(count(*) FILTER (WHERE readme_snippet = '{README_MISSING}') AS DOUBLE) / nullif(count(*), 0), 6) AS share
FROM attached""",
    ),
)
def q_missing_ratio(spark, sf_dir):
    return A.missing_ratio(readme_attached(spark, sf_dir)).withColumn("share", r6("share"))


def catalogue_with_repeats(spark, sf_dir):
    """The catalogue plus labelled rows stored a second time (a resumed scan
    that appended them again)."""
    c = standins.catalogue(spark, sf_dir).withColumn("doc_id", F.substring_index("name", "-", -1).cast("bigint"))
    lab = standins.table(spark, sf_dir, "labels").select("doc_id")
    return c.unionByName(c.join(lab, "doc_id", "left_semi")).drop("doc_id")


REPEATS_SQL = CATALOGUE_SQL + """,
repeats AS (SELECT * FROM catalogue UNION ALL SELECT * FROM catalogue WHERE doc_id IN (SELECT doc_id FROM labels))"""


@query(
    "unique_vs_total",
    with_(REPEATS_SQL, "SELECT (SELECT count(*) FROM (SELECT DISTINCT account, name FROM repeats)) AS unique_keys, count(*) AS total_rows FROM repeats"),
)
def q_unique_vs_total(spark, sf_dir):
    return A.unique_vs_total(catalogue_with_repeats(spark, sf_dir), KEY)


def _long_scores_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT account, name, '{s}' AS goal, {s}_score AS score, {s}_reason AS reason, summary, created_at FROM goal_scored"
        for s in GOAL_SLUGS
    )


@query(
    "score_histogram",
    with_(
        GOAL_SCORED_SQL + f",\nlong AS ({_long_scores_sql()}),\n"
        + "grid AS (SELECT goal, score_bin FROM (VALUES "
        + ", ".join(f"('{s}')" for s in GOAL_SLUGS)
        + ") g(goal), range(0, 6) r(score_bin))",
        """SELECT g.goal, CAST(g.score_bin AS INTEGER) AS score_bin, CAST(count(l.score) AS BIGINT) AS "count"
FROM grid g LEFT JOIN long l ON l.goal = g.goal AND CAST(floor(l.score) AS BIGINT) = g.score_bin
GROUP BY g.goal, g.score_bin""",
    ),
)
def q_score_histogram(spark, sf_dir):
    return A.score_histogram(goal_scored(spark, sf_dir), GOAL_SLUGS)


TOTAL_SQL = " + ".join(f"coalesce({s}_score, 0)" for s in GOAL_SLUGS)


@query("total_score", with_(GOAL_SCORED_SQL, f"SELECT account, name, round({TOTAL_SQL}, 6) AS total_score FROM goal_scored"))
def q_total_score(spark, sf_dir):
    g = goal_scored(spark, sf_dir)
    return g.select(*KEY, r6(A.total_score([f"{s}_score" for s in GOAL_SLUGS])).alias("total_score"))


@query(
    "final_topics",
    with_(CLASSIFIED_SQL, f"SELECT DISTINCT topic FROM (SELECT topic FROM classified WHERE topic IS NOT NULL UNION ALL SELECT '{UNCATEGORIZED}')"),
)
def q_final_topics(spark, sf_dir):
    return A.final_topics(classified(spark, sf_dir))


@query("cluster_count", with_(CLUSTERS_SQL, "SELECT count(DISTINCT cluster_id) FILTER (WHERE cluster_id <> -1) AS clusters FROM clusters"))
def q_cluster_count(spark, sf_dir):
    return A.cluster_count(clusters_standin(spark, sf_dir))


def _md5_key_sql(seed: int, a: str = "account", b: str = "name") -> str:
    return f"md5('{seed}|' || coalesce(CAST({a} AS VARCHAR), '') || '/' || coalesce(CAST({b} AS VARCHAR), ''))"


SAMPLED_SQL = SUMMARISED_SQL + ",\n" + CLUSTERS_SQL + f""",
joined AS (SELECT s.account, s.name, s.summary, c.cluster_id FROM summarised s JOIN clusters c ON c.vec_id = s.doc_id),
sampled AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY {_md5_key_sql(42)}, account, name) AS sample_rank
            FROM joined QUALIFY sample_rank <= 5)"""


def sampled_clusters(spark, sf_dir, n: int = 5):
    s = summarised(spark, sf_dir, keep_doc_id=True)
    cl = clusters_standin(spark, sf_dir)
    j = s.join(cl, s.doc_id == cl.vec_id).select(*KEY, "summary", "cluster_id")
    return W.sample_per_group(j, "cluster_id", n, 42)


@query(
    "cluster_prompt_text",
    with_(
        SAMPLED_SQL,
        "SELECT cluster_id, string_agg(summary, chr(10) || '- ' ORDER BY sample_rank) AS summaries FROM sampled WHERE cluster_id <> -1 GROUP BY cluster_id",
    ),
)
def q_cluster_prompt_text(spark, sf_dir):
    smp = sampled_clusters(spark, sf_dir).filter(F.col("cluster_id") != -1)
    return A.cluster_prompt_text(smp)


@query("headline", with_(CATALOGUE_SQL, 'SELECT language, count(*) AS "count" FROM catalogue WHERE language IS NOT NULL GROUP BY language ORDER BY "count" DESC, language LIMIT 1'))
def q_headline(spark, sf_dir):
    return A.headline(standins.catalogue(spark, sf_dir), "language")


# ---------------------------------------------------------- 2.5 windows
@query(
    "top_per_goal",
    with_(
        GOAL_SCORED_SQL + f",\nlong AS ({_long_scores_sql()})",
        f"""SELECT goal, account, name, score, reason, summary, {ts_sql('created_at')} AS created_at,
  CAST(row_number() OVER (PARTITION BY goal ORDER BY score DESC NULLS LAST, created_at DESC NULLS LAST, account, name) AS INTEGER) AS goal_rank
FROM long WHERE score > 0 QUALIFY goal_rank <= 5""",
    ),
)
def q_top_per_goal(spark, sf_dir):
    t = W.top_per_goal(goal_scored(spark, sf_dir), GOAL_SLUGS, 5)
    return t.select("goal", *KEY, "score", "reason", "summary", ts("created_at").alias("created_at"), "goal_rank")


@query(
    "duplicate_rows",
    with_(REPEATS_SQL, "SELECT account, name, stars FROM repeats QUALIFY count(*) OVER (PARTITION BY account, name) > 1"),
)
def q_duplicate_rows(spark, sf_dir):
    return W.duplicate_rows(catalogue_with_repeats(spark, sf_dir)).select(*KEY, "stars")


@query("sample_per_cluster", with_(SAMPLED_SQL, "SELECT cluster_id, CAST(sample_rank AS INTEGER) AS sample_rank, account, name FROM sampled"))
def q_sample_per_cluster(spark, sf_dir):
    return sampled_clusters(spark, sf_dir).select("cluster_id", "sample_rank", *KEY)


PICKS_SQL = REGISTRY_SQL + f""",
picks AS (
  SELECT "group", account FROM (SELECT DISTINCT "group", account FROM registry)
  QUALIFY row_number() OVER (PARTITION BY "group" ORDER BY {_md5_key_sql(42, '"group"', 'account')}, "group", account) = 1)"""


@query("random_per_group", with_(PICKS_SQL, 'SELECT "group", account FROM picks'))
def q_random_per_group(spark, sf_dir):
    flat = ingest.flatten_registry(standins.registry(spark, sf_dir)).distinct()
    return W.random_per_group(flat, 42)


@query(
    "target_accounts",
    with_(PICKS_SQL, f"SELECT DISTINCT account FROM (SELECT account FROM picks UNION ALL SELECT c_name FROM customer WHERE c_name IN ({ALLOWED_SQL}))"),
)
def q_target_accounts(spark, sf_dir):
    reg = standins.registry(spark, sf_dir)
    targets = ingest.account_names(reg, ALLOWED)
    picks = W.random_per_group(ingest.flatten_registry(reg).distinct(), 42)
    return U.target_accounts(targets, picks)


TEXT_CLUSTERED_SQL = CLASSIFIED_SQL + """,
tc AS (SELECT c.account, c.name, c.summary, c.topic, e.label AS text_cluster
       FROM classified c JOIN embeddings e ON e.vec_id = c.doc_id)"""


def text_clustered(spark, sf_dir):
    c = classified(spark, sf_dir).withColumn("doc_id", F.substring_index("name", "-", -1).cast("bigint"))
    e = standins.vectors(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), F.col("label").alias("text_cluster"))
    return c.join(e, "doc_id").drop("doc_id")


@query(
    "topics_per_cluster",
    with_(
        TEXT_CLUSTERED_SQL,
        """SELECT text_cluster, topic, "count", CAST(topic_rank AS INTEGER) AS topic_rank FROM (
  SELECT text_cluster, topic, count(*) AS "count",
         row_number() OVER (PARTITION BY text_cluster ORDER BY count(*) DESC, topic) AS topic_rank
  FROM tc WHERE topic IS NOT NULL AND text_cluster IS NOT NULL GROUP BY text_cluster, topic) WHERE topic_rank <= 5""",
    ),
)
def q_topics_per_cluster(spark, sf_dir):
    return W.topics_per_cluster(text_clustered(spark, sf_dir), 5)


@query(
    "examples_per_cluster",
    with_(
        TEXT_CLUSTERED_SQL,
        """SELECT text_cluster, CAST(row_number() OVER (PARTITION BY text_cluster ORDER BY account, name) AS INTEGER) AS example_rank,
  account, name, summary FROM tc QUALIFY example_rank <= 3""",
    ),
)
def q_examples_per_cluster(spark, sf_dir):
    return W.examples_per_cluster(text_clustered(spark, sf_dir), 3)


# ----------------------------------------------------------- 2.6 top-k
@query("limit_top", with_(CATALOGUE_SQL, "SELECT account, name, stars FROM catalogue ORDER BY stars DESC NULLS LAST, account, name LIMIT 25"))
def q_limit_top(spark, sf_dir):
    return T.limit_top(standins.catalogue(spark, sf_dir), 25, "stars").select(*KEY, "stars")


@query("top_values", with_(CATALOGUE_SQL, 'SELECT account, count(*) AS "count" FROM catalogue WHERE account IS NOT NULL GROUP BY account ORDER BY "count" DESC, account LIMIT 20'))
def q_top_values(spark, sf_dir):
    return T.top_values(standins.catalogue(spark, sf_dir), "account", 20)


@query(
    "high_impact",
    with_(
        GOAL_SCORED_SQL,
        f"""SELECT account, name, summary, {", ".join(f"{s}_score" for s in GOAL_SLUGS)}, round({TOTAL_SQL}, 6) AS total_score
FROM goal_scored ORDER BY {TOTAL_SQL} DESC, account, name LIMIT 10""",
    ),
)
def q_high_impact(spark, sf_dir):
    h = T.high_impact(goal_scored(spark, sf_dir), [f"{s}_score" for s in GOAL_SLUGS], 10)
    return h.withColumn("total_score", r6("total_score"))


@query("sample_rows", with_(CATALOGUE_SQL, f"SELECT account, name, description FROM catalogue ORDER BY {_md5_key_sql(62)}, account, name LIMIT 10"))
def q_sample_rows(spark, sf_dir):
    return T.sample_rows(standins.catalogue(spark, sf_dir), 10, 62).select(*KEY, "description")


# ------------------------------------------------------------- 2.7 sets
def _seeds_sql() -> str:
    rows = ", ".join(f"('{t}', {i})" for i, t in enumerate(SEED_TOPICS))
    return f"seeds(topic, rank) AS (VALUES {rows})"


@query(
    "extend_vocabulary",
    with_(
        CLASSIFIED_SQL + ",\n" + _seeds_sql() + """,
firsts AS (
  SELECT topic, min(ord) AS first_seen FROM (
    SELECT topic, row_number() OVER (ORDER BY created_at DESC, account, name) AS ord FROM classified
    WHERE topic IS NOT NULL AND topic NOT IN (SELECT topic FROM seeds)) GROUP BY topic)""",
        f"""SELECT topic, CAST(rank AS INTEGER) AS rank FROM seeds
UNION ALL
SELECT topic, CAST(row_number() OVER (ORDER BY first_seen, topic) - 1 + {len(SEED_TOPICS)} AS INTEGER) AS rank FROM firsts""",
    ),
)
def q_extend_vocabulary(spark, sf_dir):
    c = classified(spark, sf_dir)
    # Order of appearance: the reference walks rows newest first.
    found = c.select("topic", F.struct((-F.unix_micros("created_at")).alias("t"), "account", "name").alias("seen_at"))
    return U.extend_vocabulary(U.seed_topics(spark, SEED_TOPICS), found)


@query(
    "merge_results",
    with_(
        SUMMARISED_SQL,
        f"SELECT account, name, coalesce(summary, {all_words_sql('description')}) AS summary FROM summarised",
    ),
)
def q_merge_results(spark, sf_dir):
    s = summarised(spark, sf_dir)
    new = P.pending(s).select(*KEY, all_words(F.col("description")).alias("summary"))
    return U.merge_results(s, new).select(*KEY, "summary")


# ------------------------------------------------ 2.8 scalar functions
def _render_sql(template: str, values: dict[str, str]) -> str:
    import string as _s

    parts = []
    for literal, field, _, _ in _s.Formatter().parse(template):
        if literal:
            parts.append(_sql_str(literal))
        if field is not None:
            parts.append(f"coalesce(CAST({values[field]} AS VARCHAR), '')")
    return " || ".join(parts)


@query(
    "render_prompt",
    with_(SUMMARISED_SQL, f"SELECT account, name, {_render_sql(SUMMARY_TEMPLATE, {'description': 'description', 'readme': 'readme'})} AS prompt FROM summarised"),
)
def q_render_prompt(spark, sf_dir):
    return summarised(spark, sf_dir).select(*KEY, prompts.render_prompt(SUMMARY_TEMPLATE).alias("prompt"))


@query(
    "render_topic_prompt",
    with_(
        SUMMARISED_SQL,
        f"SELECT account, name, {_render_sql(TOPIC_TEMPLATE, {'summary': 'summary', 'topic_list': _sql_str(', '.join(SEED_TOPICS))})} AS prompt FROM summarised",
    ),
)
def q_render_topic_prompt(spark, sf_dir):
    return summarised(spark, sf_dir).select(*KEY, prompts.render_topic_prompt(TOPIC_TEMPLATE, "summary", SEED_TOPICS).alias("prompt"))


@query(
    "render_goal_prompt",
    with_(
        SUMMARISED_SQL,
        f"SELECT account, name, {_render_sql(GOAL_TEMPLATE, {'summary': 'summary', 'goals_formatted': _sql_str(prompts.goals_text(GOALS))})} AS prompt FROM summarised",
    ),
)
def q_render_goal_prompt(spark, sf_dir):
    return summarised(spark, sf_dir).select(*KEY, prompts.render_goal_prompt(GOAL_TEMPLATE, GOALS).alias("prompt"))


@query("slug", "SELECT c_custkey, lower(replace(c_mktsegment || ' ' || c_name, ' ', '_')) AS slug FROM customer")
def q_slug(spark, sf_dir):
    c = standins.table(spark, sf_dir, "customer")
    return c.select("c_custkey", tx.slug(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("slug"))


@query(
    "title_from_slug",
    """SELECT c_custkey, array_to_string(list_transform(string_split(lower(c_mktsegment || ' ' || c_name), ' '),
  lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM customer""",
)
def q_title_from_slug(spark, sf_dir):
    c = standins.table(spark, sf_dir, "customer")
    return c.select("c_custkey", tx.title_from_slug(tx.slug(F.concat_ws(" ", "c_mktsegment", "c_name"))).alias("title"))


@query("repo_key", with_(CATALOGUE_SQL, "SELECT account, name, account || '/' || name AS repo_key FROM catalogue"))
def q_repo_key(spark, sf_dir):
    return standins.catalogue(spark, sf_dir).select(*KEY, tx.repo_key().alias("repo_key"))


ANSWERS_SQL = "answers AS (SELECT source AS account, 'doc-' || CAST(d.doc_id AS VARCHAR) AS name, " + (
    "CASE WHEN l.quality IS NULL THEN 'I could not evaluate ' || d.lang || '.' ELSE "
    "'Here is the evaluation: ' || '{\"" + GOAL_NAMES[0] + "\": {\"score\": ' || CAST(l.quality * 5 AS VARCHAR) || "
    "', \"reason\": \"quality ' || CAST(l.quality AS VARCHAR) || '\"}, \"" + GOAL_NAMES[1] + "\": {\"score\": \"' || "
    "CAST(l.toxic + 1 AS VARCHAR) || '\"}, \"" + GOAL_NAMES[2] + "\": ' || "
    "CASE WHEN l.toxic = 1 THEN '\"n/a\"' ELSE '{\"score\": 2.5, \"reason\": \"half\"}' END || '}' || ' Hope this helps.' END AS answer "
    "FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
)


@query("extract_json", with_(ANSWERS_SQL, "SELECT account, name, nullif(regexp_extract(answer, '(?s)\\{.*\\}', 0), '') AS json FROM answers"))
def q_extract_json(spark, sf_dir):
    a = standins.goal_answers(spark, sf_dir, GOAL_NAMES)
    return a.select(*KEY, jsonx.extract_json("answer").alias("json"))


def _parsed_cols_sql() -> str:
    miss = "'Evaluation missing from LLM output.'"
    lab = "l.quality IS NOT NULL"
    s0, s1, s2, s3, s4 = GOAL_SLUGS
    return ",\n  ".join(
        [
            f"CASE WHEN {lab} THEN CAST(l.quality * 5 AS DOUBLE) ELSE 0.0 END AS {s0}_score",
            f"CASE WHEN {lab} THEN 'quality ' || CAST(l.quality AS VARCHAR) ELSE {miss} END AS {s0}_reason",
            f"CASE WHEN {lab} THEN CAST(l.toxic + 1 AS DOUBLE) ELSE 0.0 END AS {s1}_score",
            f"CASE WHEN {lab} THEN NULL ELSE {miss} END AS {s1}_reason",
            f"CASE WHEN {lab} AND l.toxic = 1 THEN NULL WHEN {lab} THEN 2.5 ELSE 0.0 END AS {s2}_score",
            f"CASE WHEN {lab} AND l.toxic = 1 THEN NULL WHEN {lab} THEN 'half' ELSE {miss} END AS {s2}_reason",
            f"0.0 AS {s3}_score", f"{miss} AS {s3}_reason", f"0.0 AS {s4}_score", f"{miss} AS {s4}_reason",
        ]
    )


@query(
    "parse_goal_scores",
    f"""SELECT d.source AS account, 'doc-' || CAST(d.doc_id AS VARCHAR) AS name,
  {_parsed_cols_sql()}
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def q_parse_goal_scores(spark, sf_dir):
    a = standins.goal_answers(spark, sf_dir, GOAL_NAMES)
    cols = jsonx.goal_score_columns(jsonx.goal_map(jsonx.extract_json("answer")), GOAL_NAMES)
    return a.select(*KEY, *[c.alias(n) for n, c in cols.items()])


VEC_TEXT_SQL = """vt AS (
  SELECT vec_id, embedding, CASE WHEN label = 3 THEN 'None' WHEN label = 4 THEN '[1.0, None]'
    WHEN label = 5 THEN '3.5' ELSE 'ok' END AS kind FROM embeddings)"""


@query(
    "parse_vector",
    with_(
        VEC_TEXT_SQL,
        """SELECT vec_id, CAST(CASE WHEN kind = 'ok' THEN len(embedding) END AS DOUBLE) AS dims,
  CASE WHEN kind = 'ok' THEN round(CAST(embedding[1] AS DOUBLE), 4) END AS first,
  CASE WHEN kind = 'ok' THEN round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) END AS norm2
FROM vt""",
    ),
)
def q_parse_vector(spark, sf_dir):
    v = standins.vectors(spark, sf_dir)
    text = (
        F.when(F.col("label") == 3, F.lit("None"))
        .when(F.col("label") == 4, F.lit("[1.0, None]"))
        .when(F.col("label") == 5, F.lit("3.5"))
        .otherwise(tx.vector_to_text("embedding"))
    )
    p = v.select("vec_id", jsonx.parse_vector(text).alias("vec"))
    return p.select(
        "vec_id",
        F.when(F.col("vec").isNotNull(), F.size("vec")).cast("double").alias("dims"),
        F.round(F.get("vec", 0), 4).alias("first"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x), 4).alias("norm2"),
    )


@query("clean_text", with_(SUMMARISED_SQL, f"SELECT account, name, {clean_text_sql('summary')} AS cleaned FROM summarised"))
def q_clean_text(spark, sf_dir):
    return summarised(spark, sf_dir).select(*KEY, tx.clean_text("summary").alias("cleaned"))


@query(
    "strip_label",
    with_(
        SUMMARISED_SQL,
        f"""SELECT account, name, trim('  Group ' || coalesce(lower(regexp_extract_all(summary, '{TOKEN_RE}')[1]), 'none') || ' ' || chr(10),
  ' ' || chr(9) || chr(10) || chr(13)) AS label FROM summarised""",
    ),
)
def q_strip_label(spark, sf_dir):
    s = summarised(spark, sf_dir)
    raw = F.concat(
        F.lit("  Group "),
        F.coalesce(F.lower(F.get(F.regexp_extract_all("summary", F.lit(TOKEN_RE), 0), 0)), F.lit("none")),
        F.lit(" \n"),
    )
    return s.select(*KEY, tx.strip_label(raw).alias("label"))


@query(
    "vector_to_text",
    """SELECT vec_id, CAST(len(embedding) AS DOUBLE) AS dims, round(CAST(embedding[1] AS DOUBLE), 5) AS first,
  round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x)), 5) AS norm2 FROM embeddings""",
)
def q_vector_to_text(spark, sf_dir):
    """F12, read back by F7."""
    text = standins.vectors(spark, sf_dir).select("vec_id", tx.vector_to_text("embedding").alias("t"))
    back = text.select("vec_id", jsonx.parse_vector("t").alias("v"))
    return back.select("vec_id", F.size("v").cast("double").alias("dims"), F.round(F.get("v", 0), 5).alias("first"),
                       F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 5).alias("norm2"))
