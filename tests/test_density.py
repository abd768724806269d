"""The density hierarchy against a brute-force restatement: components at
every distance, condensed, chosen by excess of mass."""

import os
import time

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import linkage
from tessera.operators.vectors import density_hierarchy, knn_cost
from tessera.session import SHUFFLE_CLEANUP, cut_lineage


def distance_matrix(pts, metric):
    if metric == "cosine":
        u = pts / np.linalg.norm(pts, axis=1, keepdims=True)
        d = np.maximum(1 - u @ u.T, 0)
    else:
        d = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    return np.round(d, 12)


def brute(pts, m, metric="euclidean"):
    """{point: least member of its cluster, or -1}."""
    d, n = distance_matrix(pts, metric), len(pts)
    below, parts = {frozenset([p]): 0.0 for p in range(n)}, [frozenset([p]) for p in range(n)]
    nodes = []  # (weight, members, children at the level below)
    for w in sorted(set(d[~np.eye(n, dtype=bool)].tolist())):
        label = np.arange(n)
        near = d <= w
        while True:
            new = np.array([label[near[p]].min() for p in range(n)])
            new = new[new]
            if (new == label).all():
                break
            label = new
        now = [frozenset(np.flatnonzero(label == x).tolist()) for x in set(label.tolist())]
        for part in now:
            if part not in below:
                nodes.append((w, part, [q for q in parts if q < part]))
                below[part] = w
        parts = now
        if len(parts) == 1:
            break
    children = {part: [q for q in kids if len(q) >= m] for _, part, kids in nodes}
    up = {q: (part, w) for w, part, kids in nodes for q in kids}
    inverse = lambda w: 1 / w if w > 0 else np.inf
    tops = [q for part in children for q in children[part] if len(children[part]) >= 2]
    weight = {part: w for w, part, _ in nodes}
    value, kids = {}, {}
    for top in tops:
        birth, total, at = inverse(up[top][1]), 0.0, top
        while len(children.get(at, [])) == 1:
            total += (len(at) - len(children[at][0])) * (inverse(weight[at]) - birth)
            at = children[at][0]
        total += len(at) * (inverse(weight.get(at, 0.0)) - birth)
        value[top], kids[top] = total, children.get(at, [])
    best, keep = {}, {}
    for top in sorted(tops, key=len):
        below_best = sum(best[k] for k in kids[top])
        keep[top], best[top] = value[top] >= below_best, max(value[top], below_best)
    out = dict.fromkeys(range(n), -1)
    for top in sorted(tops, key=len):
        if keep[top] and not any(top < other and keep[other] for other in tops):
            for p in top:
                out[p] = min(top)
    return out


def frame(spark, pts):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "vec_id long, embedding array<double>")


def check(spark, pts, m, metric="euclidean"):
    got = {r["vec_id"]: r["cluster_id"] for r in density_hierarchy(frame(spark, pts), m, metric=metric).collect()}
    assert got == brute(pts, m, metric)
    return got


def blobs(seed):
    rng = np.random.default_rng(seed)
    parts = [((0, 0), 0.3, 25), ((5, 5), 0.6, 30), ((5.8, 5.8), 0.2, 12), ((-6, 4), 1.0, 20), ((0, 0), 9, 15)]
    return np.concatenate([rng.normal(c, s, (n, 2)) for c, s, n in parts])


def test_hierarchy_of_blobs(spark):
    got = check(spark, blobs(11), 5)
    assert len(set(got.values())) > 2


def test_hierarchy_with_copies_ties_tiny_steps_and_far_parts(spark):
    """Twenty equal vectors near others, a grid (every step ties), merges far
    below any quantile of the distances, and parts so far apart that all listed
    neighbours lie inside: the least step out takes a search."""
    rng = np.random.default_rng(3)
    grid = np.array([(x, y) for x in range(5) for y in range(4)], dtype=float) + [30, 30]
    tiny = np.array([[-20, -20]]) + rng.normal(0, 1e-6, (12, 2)) + np.repeat([[0, 0], [1e-4, 0]], 6, axis=0)
    far = np.concatenate([rng.normal(0, 0.5, (30, 2)) + [400, 0], rng.normal(0, 0.5, (25, 2)) - [300, 9]])
    check(spark, np.concatenate([np.tile([[2.0, 2.0]], (20, 1)), [[2.0, 2.1], [2.1, 2.0]], np.tile([[7.0, 7.0]], (3, 1)), grid, tiny, far]), 5)


def test_hierarchy_of_cosines_and_small_sets(spark):
    rng = np.random.default_rng(8)
    pts = np.concatenate([rng.normal(c, 0.2, (12, 5)) for c in rng.normal(0, 1, (3, 5))] + [rng.normal(0, 1, (6, 5))])
    check(spark, pts, 4, "cosine")
    for n in (1, 9):
        assert set(check(spark, np.ones((n, 3)), 5).values()) == {-1}  # the whole set is never a cluster
    assert density_hierarchy(frame(spark, pts).limit(0), 5).count() == 0


def test_fill_down_over_any_ranges(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), float(w), None if rng.random() < 0.8 else f"v{w:.4f}") for k in (1, 2, 2, 2, 2, 2, 2, 3) for w in rng.random(40)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {(r["k"], r["w"]): r["v"] for r in linkage.fill_down(spark.createDataFrame(rows, "k long, w double, v string"), "k", ["w"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for k in (1, 2, 3):
        last = None
        for _, w, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            last = v or last
            assert got[k, w] == last


def test_vectors_look_into_few_others(spark):
    """On clustered vectors the bound from a vector's own block leaves at least
    five times fewer candidates than one from the k-th nearest pivot."""
    rng = np.random.default_rng(6)
    pts = np.concatenate([rng.normal(c, 0.05, (100, 8)) for c in rng.normal(0, 4, (20, 8))])
    k = 10
    cost = knn_cost(frame(spark, pts), k, metric="euclidean").collect()
    assert len(cost) == len(pts)
    n = len(pts)
    pivots = pts[rng.permutation(n)[: int(np.ceil(np.sqrt(n)))]]
    d = np.linalg.norm(pts[:, None] - pivots[None], axis=2)
    cell = d.argmin(1)
    radius = np.array([d[cell == c, c].max(initial=-np.inf) for c in range(len(pivots))])
    bound = np.sort(d, axis=1)[:, k]
    looked = (((d - radius[None]) <= bound[:, None]) * np.bincount(cell, minlength=len(pivots))[None]).sum()
    assert 5 * sum(r["points"] for r in cost) <= looked


def test_vectors_are_written_a_few_times_whatever_the_rounds(spark, monkeypatch):
    """Rounds write labels and steps; the vectors stay in the blocks' own table."""
    from tessera.operators import neighbours

    written = []

    def cut(df):
        written.append(set(df.columns))
        return cut_lineage(df)

    for module in (linkage, neighbours):
        monkeypatch.setattr(module, "cut_lineage", cut)
    rng = np.random.default_rng(12)
    check(spark, np.concatenate([rng.normal(c, 0.3, (20, 2)) for c in ((0, 0), (50, 0), (0, 60), (80, 80))]), 5)
    assert sum(bool(c & {"v", "rows"}) for c in written) <= 5
    assert sum("labels" in c for c in written) >= 1  # a search was needed


def sent(df):
    """The broadcasts in a plan that read a written or kept table."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*")) for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            found += [x.strip() for x in lines[i:end] if "Scan parquet" in x or "InMemoryTableScan" in x]
    return found


def test_tables_that_grow_are_never_gathered_to_be_broadcast(spark, monkeypatch):
    """With more components than the driver joins, every join of points, steps,
    chains or clusters sorts and merges, however small its tables are here. (What
    the code itself asks to broadcast has few rows, and is left out.)"""
    from tessera.operators import neighbours, vectors

    gathered, written = [], []

    def cut(df):
        written.append(df.columns)
        if "rows" not in df.columns:  # the blocks' own table counts its blocks
            gathered.extend((df.columns, x) for x in sent(df))
        return cut_lineage(df)

    for module in (linkage, neighbours, vectors):
        monkeypatch.setattr(module, "cut_lineage", cut)
    monkeypatch.setattr(linkage, "DRIVER_PARTS", 0)
    monkeypatch.setattr(F, "broadcast", lambda table: table.hint("merge"))
    rng = np.random.default_rng(5)
    pts = np.concatenate([rng.normal(c, 0.3, (14, 2)) for c in ((0, 0), (50, 0), (0, 60))] + [np.ones((7, 2))])
    got = density_hierarchy(frame(spark, pts), 5)
    gathered += [("result", x) for x in sent(got)]
    assert {r["vec_id"]: r["cluster_id"] for r in got.collect()} == brute(pts, 5)
    assert ["block", "labels", "bounds"] in written and ["id", "label", "moved"] in written  # a search, and Spark's components
    assert not gathered


def test_shuffle_files_go_with_the_write(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.splitlines() if os.path.basename(f).startswith("shuffle_")}

    before = shuffled()
    table = cut_lineage(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and table.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP, "false") == "false"


def test_first_points_by_hash_are_those_of_a_full_sort(spark):
    from tessera.operators.neighbours import _first_by_hash

    points = spark.range(5000).select("id", F.array(F.col("id").cast("double")).alias("v")).cache()
    want = [r["id"] for r in points.orderBy(F.md5(F.col("id").cast("string")), "id").limit(71).collect()]
    assert [r["id"] for r in _first_by_hash(points, 5000, 71)] == want
    one = spark.range(300).select(F.lit(7).cast("long").alias("id"), F.array(F.lit(1.0)).alias("v"))
    assert len(_first_by_hash(one, 300, 20)) == 20  # equal ids: none or all are low
    assert len(_first_by_hash(points.limit(3), 3, 9)) == 3
