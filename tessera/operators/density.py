"""Hierarchical density clusters (C2) over nested distance levels.

With one minimum sample the mutual-reachability distance is the plain
distance, so the density hierarchy is single linkage. It is built here on
a fixed ladder of levels eps_1 < ... < eps_L (lambda = 1 / eps):

1. components of the graph of edges <= eps_i at every level, each level
   starting from the labels of the finer one (labels = smallest member id,
   so a component's parent is the coarser component of its label);
2. condensed tree: a component of at least ``min_size`` points continues
   its parent's cluster when it is the parent's only large child, and
   starts a new cluster when the parent splits into several large
   children (the whole set is the root);
3. stability of a cluster: sum over its points of
   (lambda where the point leaves it - lambda at the cluster's birth);
   points still inside at the finest level leave at lambda_1;
4. excess of mass: bottom-up, a cluster is kept when its stability is at
   least the summed best of its children; top-down, a kept cluster is
   selected when no ancestor is. The root is never selected.

Every step is a DataFrame aggregation or join, one round per level; no
table is gathered on the driver. Levels are quantised, so results match
the continuous method up to the ladder's resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.vectors import connected_components
from tessera.session import cut_lineage


def nested_components(ids: DataFrame, edges: DataFrame, levels: Sequence[float]) -> DataFrame:
    """(id, level, label) for levels 1..L (ascending distances).

    Each edge is bucketed once by the first level that admits it. Level i
    contracts only its new edges onto the components of level i - 1 (edges
    inside one component disappear), merges components on that contracted
    graph and relabels: the edge work over all levels is one pass."""
    levels = sorted(levels)
    bucket = None
    for i, eps in enumerate(levels, start=1):
        cond = F.col("distance") <= eps
        bucket = F.when(cond, F.lit(i)) if bucket is None else bucket.when(cond, F.lit(i))
    e = cut_lineage(edges.select("src", "dst", bucket.alias("bucket")).filter(F.col("bucket").isNotNull()))
    labels = cut_lineage(ids.select(F.col("id"), F.col("id").alias("label")).distinct())
    out = None
    for i in range(1, len(levels) + 1):
        new = e.filter(F.col("bucket") == i)
        ls = labels.select(F.col("id").alias("src"), F.col("label").alias("ls"))
        ld = labels.select(F.col("id").alias("dst"), F.col("label").alias("ld"))
        ce = (
            new.join(ls, "src").join(ld, "dst")
            .filter(F.col("ls") != F.col("ld"))
            .select(F.col("ls").alias("src"), F.col("ld").alias("dst"))
            .distinct()
        )
        if not ce.isEmpty():
            both = ce.unionByName(ce.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
            verts = both.select(F.col("src").alias("id")).distinct()
            merged = connected_components(verts, both).select(F.col("id").alias("label"), F.col("label").alias("merged"))
            labels = cut_lineage(
                labels.join(merged, "label", "left").select("id", F.coalesce("merged", "label").alias("label"))
            )
        lvl = labels.select("id", F.lit(i).alias("level"), "label")
        out = lvl if out is None else out.unionByName(lvl)
    return cut_lineage(out)


def hierarchy_clusters(ids: DataFrame, edges: DataFrame, levels: Sequence[float], min_size: int = 5) -> DataFrame:
    """(id, cluster_id): cluster_id is the smallest member id of the
    selected cluster at its birth, -1 for outliers."""
    levels = sorted(levels)
    L = len(levels)
    lam = [1.0 / e if e > 0 else float("inf") for e in levels]
    lam_arr = F.array(*[F.lit(x) for x in lam])  # lambda of level j is lam_arr[j] (1-based)
    keep_small = StorageLevel.MEMORY_AND_DISK

    T = nested_components(ids, edges, levels)
    sizes = T.groupBy("level", "label").agg(F.count(F.lit(1)).alias("size"))
    # Parent of (level, label) = component of the member ``label`` one level up.
    up = T.select(F.col("id").alias("label"), (F.col("level") - 1).alias("level"), F.col("label").alias("parent"))
    comps = sizes.join(up, ["level", "label"], "left").filter(F.col("size") >= min_size).persist(keep_small)
    nbig = comps.groupBy((F.col("level") + 1).alias("plevel"), F.col("parent").alias("pparent")).agg(
        F.count(F.lit(1)).alias("nbig"))
    root_split = comps.filter(F.col("level") == L).limit(2).count() >= 2
    birth = (
        comps.withColumn("plevel", F.col("level") + 1)
        .withColumn("pparent", F.col("parent"))
        .join(nbig, ["plevel", "pparent"], "left")
        .select(
            "level", "label",
            F.when(F.col("level") == L, F.lit(root_split))
            .otherwise(F.coalesce(F.col("nbig"), F.lit(0)) >= 2)
            .alias("is_birth"),
        )
    )
    # Each point's path of large components, top-down; its cluster at a
    # level is the nearest birth at or above it (one window per point, at
    # most L rows each); none means the root.
    path = T.join(birth, ["level", "label"])
    w = Window.partitionBy("id").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    P = cut_lineage(
        path.select(
            "id", "level", "label", "is_birth",
            F.last(F.when(F.col("is_birth"), F.col("level")), ignorenulls=True).over(w).alias("cl_level"),
            F.last(F.when(F.col("is_birth"), F.col("label")), ignorenulls=True).over(w).alias("cl_label"),
        ).filter(F.col("cl_level").isNotNull())
    )
    comps.unpersist()

    per = P.groupBy("cl_level", "cl_label", "id").agg(F.count(F.lit(1)).alias("t"))
    leave = F.greatest(F.col("cl_level") - F.col("t"), F.lit(1))
    contrib = F.element_at(lam_arr, leave.cast("int")) - F.element_at(lam_arr, F.col("cl_level").cast("int"))
    stab = per.groupBy("cl_level", "cl_label").agg(F.sum(contrib).alias("stability"))
    # Parent cluster of a cluster born at (b, lab): the cluster of member
    # ``lab`` one level up (absent: the root).
    pa = P.select(F.col("id").alias("cl_label"), (F.col("level") - 1).alias("cl_level"),
                  F.col("cl_level").alias("pa_level"), F.col("cl_label").alias("pa_label"))
    clusters = (
        P.filter(F.col("is_birth") & (F.col("id") == F.col("label")))
        .select("cl_level", "cl_label")
        .join(pa, ["cl_level", "cl_label"], "left")
        .join(stab, ["cl_level", "cl_label"], "left")
        .select("cl_level", "cl_label", F.coalesce("pa_level", F.lit(0)).alias("pa_level"),
                F.coalesce("pa_label", F.lit(-1).cast("long")).alias("pa_label"),
                F.coalesce("stability", F.lit(0.0)).alias("stability"))
    )
    clusters = cut_lineage(clusters)

    # Excess of mass, bottom-up by birth level (one small table per level,
    # checkpointed so the plan does not grow with the levels).
    best = None
    for b in range(1, L + 1):
        cur = clusters.filter(F.col("cl_level") == b)
        if best is None:
            childsum = F.lit(0.0)
            joined = cur
        else:
            sums = best.groupBy(F.col("pa_level").alias("cl_level"), F.col("pa_label").alias("cl_label")).agg(
                F.sum("best").alias("childsum"))
            joined = cur.join(sums, ["cl_level", "cl_label"], "left")
            childsum = F.coalesce(F.col("childsum"), F.lit(0.0))
        rows = joined.select(
            "cl_level", "cl_label", "pa_level", "pa_label",
            (F.col("stability") >= childsum).alias("keep"),
            F.greatest(F.col("stability"), childsum).alias("best"),
        )
        best = cut_lineage(rows if best is None else best.unionByName(rows))

    # Selection, top-down: kept and no kept ancestor.
    sel = None
    for b in range(L, 0, -1):
        cur = best.filter(F.col("cl_level") == b)
        if sel is None:
            rows = cur.select("cl_level", "cl_label", "keep", F.lit(False).alias("blocked"))
        else:
            anc = sel.select(F.col("cl_level").alias("pa_level"), F.col("cl_label").alias("pa_label"),
                             (F.col("blocked") | F.col("keep")).alias("up_blocked"))
            rows = cur.join(anc, ["pa_level", "pa_label"], "left").select(
                "cl_level", "cl_label", "keep", F.coalesce(F.col("up_blocked"), F.lit(False)).alias("blocked"))
        sel = cut_lineage(rows if sel is None else sel.unionByName(rows))
    chosen = sel.filter(F.col("keep") & ~F.col("blocked")).select("cl_level", "cl_label")

    members = P.filter(F.col("level") == F.col("cl_level")).join(chosen, ["cl_level", "cl_label"]).select(
        "id", F.col("cl_label").alias("cluster_id"))
    return ids.select("id").join(members, "id", "left").select(
        "id", F.coalesce(F.col("cluster_id"), F.lit(-1)).cast("long").alias("cluster_id"))


def level_ladder(edges: DataFrame, n_levels: int = 16, lo: float = 0.02) -> list[float]:
    """Distance levels at evenly spaced quantiles of the edge distances
    (a distributed sketch; only the L values reach the driver)."""
    probs = [lo + (1.0 - lo) * i / (n_levels - 1) for i in range(n_levels)]
    vals = edges.approxQuantile("distance", probs, 0.001)
    return sorted(set(vals))
