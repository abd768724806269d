"""Queries for vectors and the batch classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import stubs
from tessera.operators import vectors as V
from tessera.plans.batch import classify_batch, embed_pending
from tessera.queries.registry import query
from tessera.queries.relational import with_embeddings
from tessera.queries.views import SUMMARISED_SQL, with_
from tessera.sources import standins

KEY = ["account", "name"]
# Fixed value (our own): the cosine level for the density-cluster check.
EPS = 0.65
COS = "1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


@query(
    "knn_join",
    f"""SELECT src, dst, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM (
  SELECT a.vec_id AS src, b.vec_id AS dst, {COS} AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY {COS}, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rank <= 15""",
)
def q_knn_join(spark, sf_dir):
    nn = V.knn_join(standins.vectors(spark, sf_dir), 15)
    return nn.select("src", "dst", F.col("rank").cast("int"), F.round("distance", 6).alias("distance"))


@query(
    "epsilon_join",
    f"SELECT a.vec_id AS src, b.vec_id AS dst FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE {COS} <= {EPS}",
)
def q_epsilon_join(spark, sf_dir):
    return V.epsilon_join(standins.vectors(spark, sf_dir), EPS).select("src", "dst")


@query(
    "density_clusters",
    f"""WITH RECURSIVE edges AS (
  SELECT a.vec_id AS src, b.vec_id AS dst FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE {COS} <= {EPS}),
reach(id, lab) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT e.dst, r.lab FROM reach r JOIN edges e ON e.src = r.id),
comp AS (SELECT id, min(lab) AS comp FROM reach GROUP BY id),
sizes AS (SELECT comp, count(*) AS n FROM comp GROUP BY comp)
SELECT c.id AS vec_id, CAST(CASE WHEN s.n >= 5 THEN c.comp ELSE -1 END AS BIGINT) AS cluster_id
FROM comp c JOIN sizes s ON s.comp = c.comp""",
)
def q_density_clusters(spark, sf_dir):
    return V.density_clusters(standins.vectors(spark, sf_dir), EPS, 5)


def hierarchy_sql(distance: str, least: int) -> str:
    """Single linkage of all pairs: a spanning tree gives the least largest step
    between any two vectors, so each vector's components at every distance; then
    the condensed tree and excess of mass."""
    inverse = "CASE WHEN {0} > 0 THEN 1 / {0} ELSE 'Infinity'::DOUBLE END"
    return f"""WITH RECURSIVE d AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b, round({distance}, 12) AS w FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
grown AS (
  SELECT 1 AS n, b AS id, w, a AS parent, row_number() OVER (ORDER BY w, b) = 1 AS taken FROM d WHERE a = (SELECT min(vec_id) FROM embeddings)
  UNION ALL
  SELECT n, id, w, parent, row_number() OVER (ORDER BY w, id) = 1 FROM (
    SELECT g.n + 1 AS n, g.id, least(g.w, d.w) AS w, CASE WHEN d.w < g.w THEN d.a ELSE g.parent END AS parent
    FROM (SELECT *, max(CASE WHEN taken THEN id END) OVER () AS newest FROM grown) g JOIN d ON d.a = g.newest AND d.b = g.id WHERE NOT g.taken)),
steps AS MATERIALIZED (SELECT id AS a, parent AS b, w FROM grown WHERE taken UNION ALL SELECT parent, id, w FROM grown WHERE taken),
ways AS (
  SELECT a AS src, b AS id, a AS prior, w FROM steps
  UNION ALL SELECT ways.src, steps.b, ways.id, greatest(ways.w, steps.w) FROM ways JOIN steps ON steps.a = ways.id AND steps.b <> ways.prior),
counted AS (
  SELECT src, w, 1 + count(*) OVER o AS size, least(src, min(id) OVER o) AS label FROM ways WINDOW o AS (PARTITION BY src ORDER BY w)),
parts AS MATERIALIZED (SELECT DISTINCT src, w, size, label FROM counted),
linked AS (SELECT src, w, label, size, lead(w) OVER up AS up_w, lead(label) OVER up AS up_label FROM parts WINDOW up AS (PARTITION BY src ORDER BY w)),
large AS MATERIALIZED (SELECT label, w, size, up_w, up_label FROM linked WHERE src = label AND size >= {least}),
splits AS (SELECT up_label AS label, up_w AS w FROM large WHERE up_w IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
tops AS MATERIALIZED (SELECT l.label, l.w, l.up_w, l.up_label FROM large l JOIN splits s ON s.label = l.up_label AND s.w = l.up_w),
paths AS MATERIALIZED (
  SELECT p.src, p.w, p.label, last_value(t.w IGNORE NULLS) OVER o AS top_w, last_value(t.label IGNORE NULLS) OVER o AS top_label
  FROM parts p LEFT JOIN tops t ON t.label = p.label AND t.w = p.w WHERE p.size >= {least}
  WINDOW o AS (PARTITION BY p.src ORDER BY p.w DESC)),
leaves AS (SELECT src, top_label, top_w, min(w) AS low FROM paths WHERE top_w IS NOT NULL GROUP BY ALL),
stable AS (
  SELECT t.label, t.w, sum({inverse.format("low")} - {inverse.format("t.up_w")}) AS stability
  FROM leaves JOIN tops t ON t.label = top_label AND t.w = top_w GROUP BY t.label, t.w),
family AS MATERIALIZED (
  SELECT t.label || ':' || t.w AS cid, p.top_label || ':' || p.top_w AS parent, s.stability, t.label, t.w, row_number() OVER (ORDER BY t.w, t.label) AS i
  FROM tops t JOIN stable s ON s.label = t.label AND s.w = t.w JOIN paths p ON p.src = t.up_label AND p.label = t.up_label AND p.w = t.up_w),
kids AS (SELECT f.*, coalesce((SELECT list(c.cid) FROM family c WHERE c.parent = f.cid), []) AS below FROM family f),
mass AS (
  SELECT 0::BIGINT AS i, MAP([]::VARCHAR[], []::DOUBLE[]) AS best
  UNION ALL
  SELECT k.i, map_concat(m.best, MAP([k.cid], [greatest(k.stability, coalesce(list_sum(list_transform(k.below, lambda c: m.best[c])), 0))])) FROM mass m JOIN kids k ON k.i = m.i + 1),
kept AS (
  SELECT k.* FROM kids k, (SELECT best FROM mass ORDER BY i DESC LIMIT 1) m
  WHERE k.stability >= coalesce(list_sum(list_transform(k.below, lambda c: m.best[c])), 0)),
above AS (
  SELECT cid, parent FROM family UNION ALL SELECT above.cid, f.parent FROM above JOIN family f ON f.cid = above.parent),
picked AS (SELECT label, w FROM kept WHERE cid NOT IN (SELECT cid FROM above WHERE parent IN (SELECT cid FROM kept)))
SELECT e.vec_id, coalesce((SELECT min(p.label) FROM paths p JOIN picked c ON c.label = p.label AND c.w = p.w WHERE p.src = e.vec_id), -1) AS cluster_id FROM embeddings e"""


@query("density_hierarchy", hierarchy_sql(COS, 5))
def q_density_hierarchy(spark, sf_dir):
    """C2, hierarchical: single linkage of all pairs, excess of mass."""
    return V.density_hierarchy(standins.vectors(spark, sf_dir), 5, metric="cosine")


PLANE = "sqrt(" + " + ".join(f"(a.embedding[{i}]::DOUBLE - b.embedding[{i}]::DOUBLE) ** 2" for i in (1, 2)) + ")"


@query("density_hierarchy_plane", hierarchy_sql(PLANE, 6))
def q_density_hierarchy_plane(spark, sf_dir):
    """C2 by Euclidean distance of the first two coordinates, where clusters
    lie in one another."""
    vectors = standins.vectors(spark, sf_dir).withColumn("embedding", F.slice("embedding", 1, 2))
    return V.density_hierarchy(vectors, 6, metric="euclidean")


@query("reduce_dims")
def q_reduce_dims(spark, sf_dir):
    r = V.reduce_dims(standins.vectors(spark, sf_dir), 10)
    return r.select("vec_id", F.size("reduced").alias("dims"),
                    F.round(F.aggregate("reduced", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))


@query(
    "embed",
    with_(
        SUMMARISED_SQL,
        """SELECT account, name, 64 AS dims, 1.0 AS norm FROM summarised s
WHERE s.summary IS NOT NULL AND NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = s.doc_id)""",
    ),
)
def q_embed(spark, sf_dir):
    """M5 on the pending rows only (rows with a stored vector pass through
    untouched); stub vectors are 64-dim unit vectors."""
    rows = embed_pending(with_embeddings(spark, sf_dir).drop("doc_id"), stubs.hash_embedding(64))
    todo = with_embeddings(spark, sf_dir).filter(F.col("summary").isNotNull() & F.col("embedding").isNull())
    new = rows.join(todo.select(*KEY), KEY, "left_semi")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return new.select(*KEY, F.size("embedding").alias("dims"), F.round(norm, 4).alias("norm"))


@query("classify_batch")
def q_classify_batch(spark, sf_dir):
    out, _topics = classify_batch(
        with_embeddings(spark, sf_dir).drop("doc_id"), stubs.hash_embedding(64), stubs.cluster_label(),
        stubs.LABEL_TEMPLATE,
    )
    return out.select(*KEY, "topic")
