"""Queries for text clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import textmine as TM
from tessera.operators import windows as W
from tessera.operators import topk as T
from tessera.plans.topics import topic_report
from tessera.queries.registry import query, r6
from tessera.queries.relational import _stops_sql
from tessera.queries.views import CLASSIFIED_SQL, SUMMARISED_SQL, classified, summarised, with_
from tessera.schemas import UNCATEGORIZED
from tessera.session import cut_lineage
from tessera.sources import standins

KEY = ["account", "name"]


def _tfidf_ctes(source: str) -> str:
    """Weights ``x`` (d, account, name, t, w) of the documents of ``source``
    (account, name, summary); ``docs`` are those with any token."""
    spaced = "regexp_replace(lower(coalesce(summary, '')), '[^\\p{L}\\p{N}_]', ' ', 'g')"
    tokens = (
        f"list_filter(string_split_regex(trim({spaced}), ' +'), "
        f"lambda w: length(w) >= 3 AND NOT list_contains({_stops_sql()}, w))"
    )
    return f"""
toks AS (SELECT account, name, {tokens} AS tokens FROM {source}),
docs AS MATERIALIZED (SELECT account, name, tokens, account || '/' || name AS d FROM toks WHERE len(tokens) > 0),
ndocs AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM docs),
tf AS (SELECT account, name, d, term, count(*) AS tf FROM (SELECT account, name, d, unnest(tokens) AS term FROM docs) GROUP BY ALL),
stats AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term),
vocab AS (SELECT term, df FROM stats, ndocs WHERE df >= {TM.MIN_DF} AND df <= {TM.MAX_DF} * ndocs.n
          ORDER BY total DESC, term LIMIT {TM.MAX_FEATURES}),
indexed AS MATERIALIZED (SELECT term, df, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index FROM vocab),
w AS (SELECT tf.account, tf.name, tf.d, tf.term, v.term_index,
             tf.tf * (ln((1 + ndocs.n) / (1 + v.df)) + 1) AS raw
      FROM tf JOIN indexed v ON v.term = tf.term, ndocs),
x AS MATERIALIZED (SELECT account, name, d, term, term_index AS t, raw / sqrt(sum(raw * raw) OVER (PARTITION BY d)) AS w FROM w)"""


def _kmeans_ctes(ks: range, rounds: int) -> str:
    """k-means for all of ``ks``: ``final`` (d, k, c, cost) and the centres
    ``centres`` (k, c, t, w)."""
    out = f"""
squares AS MATERIALIZED (SELECT docs.d, coalesce(sum(x.w * x.w), 0) AS xx FROM docs LEFT JOIN x ON x.d = docs.d GROUP BY docs.d),
seeds AS (SELECT d, row_number() OVER (ORDER BY md5(d), account, name) - 1 AS c FROM docs),
pairs AS MATERIALIZED (SELECT k, c FROM (SELECT k FROM range({ks.start}, {ks.stop}) r(k) WHERE k <= (SELECT count(*) FROM docs)), range({ks.stop}) s(c) WHERE c < k),
c0 AS MATERIALIZED (SELECT k, pairs.c, t, w FROM pairs JOIN seeds ON seeds.c = pairs.c JOIN x ON x.d = seeds.d)"""

    def assigned(r: int) -> str:
        return f"""
a{r} AS MATERIALIZED (
  SELECT d, k, c, cost FROM (
    SELECT s.d, p.k, p.c, greatest(s.xx + coalesce(q.cc, 0) - 2 * coalesce(g.dot, 0), 0) AS cost
    FROM squares s CROSS JOIN pairs p LEFT JOIN (SELECT k, c, sum(w * w) AS cc FROM c{r} GROUP BY k, c) q ON q.k = p.k AND q.c = p.c
    LEFT JOIN (SELECT x.d, k, c, sum(x.w * c{r}.w) AS dot FROM x JOIN c{r} ON c{r}.t = x.t GROUP BY x.d, k, c) g ON g.d = s.d AND g.k = p.k AND g.c = p.c)
  QUALIFY row_number() OVER (PARTITION BY d, k ORDER BY round(cost, {TM.NEAR_DIGITS}), c) = 1)"""

    for r in range(rounds):
        out += "," + assigned(r) + f""",
n{r} AS MATERIALIZED (SELECT k, c, count(*) AS n FROM a{r} GROUP BY k, c),
c{r + 1} AS MATERIALIZED (
  SELECT a{r}.k, a{r}.c, x.t, sum(x.w) / any_value(n) AS w FROM a{r} JOIN x ON x.d = a{r}.d JOIN n{r} ON n{r}.k = a{r}.k AND n{r}.c = a{r}.c GROUP BY a{r}.k, a{r}.c, x.t
  UNION ALL SELECT k, c, t, w FROM c{r} WHERE (k, c) NOT IN (SELECT (k, c) FROM n{r}))"""
    return out + "," + assigned(rounds) + f""",
final AS (SELECT a.*, docs.account, docs.name FROM a{rounds} a JOIN docs ON docs.d = a.d),
centres AS (SELECT k, c, t, w FROM c{rounds})"""


ALL_K, ONE_K = range(2, TM.K_MAX + 1), range(TM.DEFAULT_K, TM.DEFAULT_K + 1)
INERTIA = ",\ninertia AS (SELECT k, sum(cost) AS v FROM final GROUP BY k)"
BENDS = """,
bends AS (SELECT k, lead(v) OVER w - 2 * v + lag(v) OVER w AS bend FROM inertia WINDOW w AS (ORDER BY k)),
elbow AS (SELECT CAST(k AS INTEGER) AS k FROM bends WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1)"""


def _summaries(ks: range) -> str:
    return SUMMARISED_SQL + "," + _tfidf_ctes("summarised") + "," + _kmeans_ctes(ks, TM.ROUNDS)


@query("tfidf", with_(SUMMARISED_SQL + "," + _tfidf_ctes("summarised"), "SELECT account, name, term, t AS term_index, round(w, 6) AS weight FROM x"))
def q_tfidf(spark, sf_dir):
    t = TM.tfidf(summarised(spark, sf_dir), "summary", KEY)
    return t.long.select(*KEY, "term", "term_index", r6("weight").alias("weight"))


def _fitted(spark, sf_dir, ks=None):
    t = TM.tfidf(summarised(spark, sf_dir), "summary", KEY)
    rows = cut_lineage(t.rows)
    return t, rows, TM.kmeans(rows, KEY, len(t.vocab), ks)


@query("kmeans_inertia", with_(_summaries(ALL_K) + INERTIA, "SELECT CAST(k AS INTEGER) AS k, round(v, 6) AS inertia FROM inertia"))
def q_kmeans_inertia(spark, sf_dir):
    return _fitted(spark, sf_dir)[2].inertia(spark).select("k", r6("inertia").alias("inertia"))


@query("elbow", with_(_summaries(ALL_K) + INERTIA + BENDS, "SELECT k FROM elbow"))
def q_elbow(spark, sf_dir):
    return W.elbow(_fitted(spark, sf_dir)[2].inertia(spark))


@query("kmeans_assign", with_(_summaries(ONE_K), "SELECT account, name, CAST(c AS INTEGER) AS text_cluster FROM final"))
def q_kmeans_assign(spark, sf_dir):
    _, rows, models = _fitted(spark, sf_dir, [TM.DEFAULT_K])
    return TM.kmeans_assign(rows, TM.DEFAULT_K, KEY, models)


@query(
    "top_terms",
    with_(
        _summaries(ONE_K),
        """SELECT CAST(cluster AS INTEGER) AS cluster, CAST(term_rank AS INTEGER) AS term_rank, term, round(weight, 6) AS weight FROM (
  SELECT p.c AS cluster, i.term, round(coalesce(m.w, 0), 12) AS weight,
         row_number() OVER (PARTITION BY p.c ORDER BY round(coalesce(m.w, 0), 12) DESC, i.term_index DESC) AS term_rank
  FROM pairs p CROSS JOIN indexed i LEFT JOIN centres m ON m.c = p.c AND m.t = i.term_index) WHERE term_rank <= 10""",
    ),
)
def q_top_terms(spark, sf_dir):
    t, _, models = _fitted(spark, sf_dir, [TM.DEFAULT_K])
    top = W.top_terms(models.long(spark, TM.DEFAULT_K), t.vocab_df())
    return top.select("cluster", "term_rank", "term", r6("weight").alias("weight"))


@query("pca_2d")
def q_pca_2d(spark, sf_dir):
    """Checked against numpy's decomposition in pytest."""
    t = TM.tfidf(summarised(spark, sf_dir), "summary", KEY)
    return TM.pca_2d(t.rows, KEY, len(t.vocab))


@query("cluster_sizes", "SELECT label AS text_cluster, count(*) AS count FROM embeddings GROUP BY label")
def q_cluster_sizes(spark, sf_dir):
    return T.cluster_sizes(standins.vectors(spark, sf_dir).withColumnRenamed("label", "text_cluster"))


@query(
    "elbow_fixed",
    """WITH inertia AS (SELECT label + 2 AS k, sum(vec_id % 97 + label * label) AS v FROM embeddings GROUP BY label),
bends AS (SELECT k, lead(v) OVER w - 2 * v + lag(v) OVER w AS bend FROM inertia WINDOW w AS (ORDER BY k))
SELECT CAST(k AS INTEGER) AS k FROM bends WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1""",
)
def q_elbow_fixed(spark, sf_dir):
    """W7 on a table that SQL can restate: a value for each K from the vectors."""
    v = standins.vectors(spark, sf_dir)
    inertia = v.groupBy((F.col("label") + 2).alias("k")).agg(F.sum(F.col("vec_id") % 97 + F.col("label") * F.col("label")).cast("double").alias("inertia"))
    return W.elbow(inertia)


REPORTED_SQL = CLASSIFIED_SQL + f""",
filled AS (SELECT account, name, coalesce(summary, '') AS summary, coalesce(topic, '') AS topic FROM classified WHERE topic IS DISTINCT FROM '{UNCATEGORIZED}')"""


@query(
    "topic_report",
    with_(
        REPORTED_SQL + "," + _tfidf_ctes("filled") + "," + _kmeans_ctes(ALL_K, TM.ROUNDS) + INERTIA + BENDS,
        """SELECT text_cluster, topic, "count", CAST(topic_rank AS INTEGER) AS topic_rank, k FROM (
  SELECT CAST(c AS INTEGER) AS text_cluster, topic, count(*) AS "count", any_value(elbow.k) AS k,
         row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, topic) AS topic_rank
  FROM final JOIN elbow ON elbow.k = final.k JOIN filled f ON f.account = final.account AND f.name = final.name
  GROUP BY c, topic) WHERE topic_rank <= 5""",
    ),
)
def q_topic_report(spark, sf_dir):
    """E5 end to end; returns the per-cluster topic table."""
    rep = topic_report(classified(spark, sf_dir))
    return rep["topics_per_cluster"].withColumn("k", F.lit(rep["k"]))
