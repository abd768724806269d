"""Vector operators: exact kNN join (J8), epsilon join, PCA reduction
and density clusters (C2), at one level or as a hierarchy. The searches run in
blocks of near vectors (``neighbours.py``), the hierarchy is exact single linkage
(``linkage.py``)."""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.neighbours import connecting, lay_out, search_cost, star_forest, within
from tessera.operators.textmine import principal_axes, project
from tessera.session import cut_lineage, merging


def as_double_array(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def _norm(c) -> F.Column:
    return F.sqrt(F.aggregate(as_double_array(c), F.lit(0.0), lambda a, x: a + x * x))


def unit(c) -> F.Column:
    """Scale to unit length (cosine order = Euclidean order on unit
    vectors); zero vectors become null. The norm is a variable of its own: inside
    the inner function it would be taken anew for each coordinate."""
    scaled = F.transform(F.array(_norm(c)), lambda norm: F.when(norm > 0, F.transform(as_double_array(c), lambda x: x / norm)))
    return F.get(scaled, 0)


def _points(vectors: DataFrame, id_col: str, vec_col: str, metric: str) -> DataFrame:
    # The filter asks for less than the vectors, which would be made twice.
    some, v = (_norm(vec_col) > 0, unit(vec_col)) if metric == "cosine" else (F.col(vec_col).isNotNull(), as_double_array(vec_col))
    return vectors.filter(some).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def knn_join(vectors: DataFrame, k: int = 15, id_col: str = "vec_id", vec_col: str = "embedding",
             metric: str = "cosine") -> DataFrame:
    """The k nearest other vectors of every vector, exactly:
    (src, dst, distance, rank); cosine distance = 1 - cos."""
    blocks = lay_out(cut_lineage(_points(vectors, id_col, vec_col, metric)), k)
    if blocks is None:
        return vectors.sparkSession.createDataFrame([], "src long, dst long, distance double, rank int")
    pairs = cut_lineage(within(blocks, metric, k))
    w = Window.partitionBy("src").orderBy("distance", "dst")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_cost(vectors: DataFrame, k: int = 15, id_col: str = "vec_id", vec_col: str = "embedding",
             metric: str = "cosine") -> DataFrame:
    """What ``knn_join`` compares: (id, blocks, points) of each vector, the blocks
    it looks into and the vectors that they hold."""
    blocks = lay_out(cut_lineage(_points(vectors, id_col, vec_col, metric)), k)
    if blocks is None:
        return vectors.sparkSession.createDataFrame([], "id long, blocks long, points long")
    return search_cost(blocks)


_star_forest = star_forest


def _within_eps(vectors: DataFrame, eps: float, id_col: str, vec_col: str, metric: str, forest: bool = False) -> DataFrame:
    blocks = lay_out(cut_lineage(_points(vectors, id_col, vec_col, metric)), None)
    if blocks is None:
        return vectors.sparkSession.createDataFrame([], "src long, dst long, distance double")
    if metric == "cosine":
        eps = math.sqrt(2.0 * eps)  # cosine distance -> chord length on unit vectors
    blocks.table = blocks.table.withColumn("bounds", F.transform("bounds", lambda _: F.lit(float(eps))))
    return cut_lineage(connecting(blocks, metric) if forest else within(blocks, metric, None))


def epsilon_join(vectors: DataFrame, eps: float, id_col: str = "vec_id", vec_col: str = "embedding",
                 metric: str = "cosine") -> DataFrame:
    """All ordered pairs within ``eps`` (both directions), exactly."""
    return _within_eps(vectors, eps, id_col, vec_col, metric)


def connected_components(vertices: DataFrame | None, edges: DataFrame, max_rounds: int | None = None,
                         init: DataFrame | None = None) -> DataFrame:
    """Smallest member id per component by min-label propagation with a
    pointer-jumping step each round; each round is checkpointed (reliable
    storage) and the loop ends when no label changes. ``init`` (id, label)
    starts from the components of a sub-graph (labels must be member ids)."""
    if init is not None:
        labels = init.select("id", "label")
    else:
        labels = vertices.select(F.col("id"), F.col("id").alias("label")).distinct()
    # Starting labels and edges are read in every round: keep them (their
    # lineage is short, so a lost executor just recomputes them); each
    # round's labels are written as a table below.
    labels = labels.persist(StorageLevel.MEMORY_AND_DISK)
    e = edges.select("src", "dst").persist(StorageLevel.MEMORY_AND_DISK)
    first = labels
    rounds = 0
    while True:
        rounds += 1
        prop = e.join(merging(labels.withColumnRenamed("id", "src")), "src").select(F.col("dst").alias("id"), "label")
        step = labels.unionByName(prop).groupBy("id").agg(F.min("label").alias("label")).persist(
            StorageLevel.MEMORY_AND_DISK)
        # Pointer jumping: adopt the label of one's label.
        via = step.select(F.col("id").alias("via_id"), F.col("label").alias("via_label"))
        hop = step.join(merging(via), step["label"] == via["via_id"], "left").select(
            "id", F.least(F.col("label"), F.coalesce(F.col("via_label"), F.col("label"))).alias("label")
        )
        old = labels.select("id", F.col("label").alias("old_label"))
        # One reliable checkpoint per round, carrying the change flag.
        new = cut_lineage(hop.join(merging(old), "id").select("id", "label", (F.col("label") != F.col("old_label")).alias("moved")))
        step.unpersist()
        labels = new.select("id", "label")
        if new.filter(F.col("moved")).limit(1).count() == 0 or (max_rounds is not None and rounds >= max_rounds):
            first.unpersist()
            e.unpersist()
            return labels


def epsilon_forest(vectors: DataFrame, eps: float, id_col: str = "vec_id", vec_col: str = "embedding",
                   metric: str = "cosine") -> DataFrame:
    """Edges with the connectivity of the eps-graph: of each task at most one for
    each point that it holds or that comes to it (so a dense group of m points gives
    about m edges for each row and column of the grid, not m^2)."""
    e = _within_eps(vectors, eps, id_col, vec_col, metric, forest=True).select("src", "dst")
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def density_clusters(vectors: DataFrame, eps: float, min_size: int = 5, id_col: str = "vec_id",
                     vec_col: str = "embedding", metric: str = "cosine") -> DataFrame:
    """C2 at a fixed level: components of the eps-graph (single linkage cut
    at eps, which is what density clustering with one minimum sample gives
    at that level); components smaller than ``min_size`` are outliers (-1).
    Cluster id = smallest member id. Returns (id_col, cluster_id)."""
    edges = epsilon_forest(vectors, eps, id_col, vec_col, metric)
    verts = vectors.select(F.col(id_col).cast("long").alias("id"))
    comp = connected_components(verts, edges)
    sizes = comp.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    return comp.join(sizes, "label").select(
        F.col("id").alias(id_col),
        F.when(F.col("size") >= min_size, F.col("label")).otherwise(F.lit(-1)).cast("long").alias("cluster_id"),
    )


def default_eps(vectors: DataFrame, k: int, id_col: str, vec_col: str, metric: str, q: float = 0.5) -> float:
    """A data-driven level: the median distance to the k-th neighbour."""
    nn = knn_join(vectors, k, id_col, vec_col, metric).filter(F.col("rank") == k)
    vals = nn.approxQuantile("distance", [q], 0.001)
    return float(vals[0]) if vals else 0.0


def reduce_dims(df: DataFrame, k: int = 10, vec_col: str = "embedding", out_col: str = "reduced") -> DataFrame:
    """C1 re-aimed: cosine geometry (unit length; a zero or null vector stays at
    zero), then the k principal axes, by products that the partitions sum up."""
    index, weight = "__index", "__weight"
    v = F.coalesce(unit(vec_col), as_double_array(vec_col), F.array().cast("array<double>"))
    places = F.when(F.size(weight) > 0, F.sequence(F.lit(0), F.size(weight) - 1)).otherwise(F.array().cast("array<int>"))
    rows = cut_lineage(df.withColumn(weight, v).withColumn(index, places))
    packed = rows.select(F.struct(*df.columns).alias("__row"), F.col(index).alias("term_index"), F.col(weight).alias("weight"))
    width = rows.agg(F.max(F.size(weight))).first()[0] or 0
    axes, _, _, _ = principal_axes(packed, width, min(k, width))
    out = project(packed, ["__row"], axes, np.zeros(axes.shape[1]), out_col)
    return out.select(*[F.col(f"__row.`{c}`").alias(c) for c in df.columns if c != out_col], out_col)


def density_hierarchy(vectors: DataFrame, min_size: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                      metric: str = "euclidean") -> DataFrame:
    """C2, hierarchical: exact single linkage over all pairs, condensed to
    clusters of at least ``min_size`` points and chosen by excess of mass.
    Returns (id_col, cluster_id); vectors that are null (or, for cosine, of
    length 0) are outliers like any other point in no cluster."""
    from tessera.operators import linkage

    found = linkage.density_hierarchy(_points(vectors, id_col, vec_col, metric), min_size, metric)
    ids = vectors.select(F.col(id_col).cast("long").alias("id"))
    return ids.join(merging(found), "id", "left").select(F.col("id").alias(id_col), F.coalesce("cluster_id", F.lit(-1)).cast("long").alias("cluster_id"))
