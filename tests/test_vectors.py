"""Vector operators against numpy brute force and planted clusters."""

import numpy as np
import pytest

from tessera.operators import neighbours as N
from tessera.operators import vectors as V


def planted(n_clusters=4, per=12, noise=10, dim=16, seed=7):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n_clusters, dim)) * 5
    pts, truth = [], []
    for c in range(n_clusters):
        for _ in range(per):
            pts.append(centres[c] + rng.standard_normal(dim) * 0.05)
            truth.append(c)
    for _ in range(noise):
        pts.append(rng.standard_normal(dim) * 20)
        truth.append(-1)
    return np.array(pts), truth


def frame(spark, pts):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_knn_exact_against_brute_force(spark, metric):
    pts = np.random.default_rng(1).standard_normal((80, 6))
    got = V.knn_join(frame(spark, pts), 5, metric=metric).collect()
    if metric == "cosine":
        u = pts / np.linalg.norm(pts, axis=1, keepdims=True)
        d = 1 - u @ u.T
    else:
        d = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    np.fill_diagonal(d, np.inf)
    ref = {(i, int(j)) for i in range(len(pts)) for j in np.argsort(d[i], kind="stable")[:5]}
    assert {(r["src"], r["dst"]) for r in got} == ref
    for r in got:
        assert r["distance"] == pytest.approx(d[r["src"], r["dst"]], abs=1e-9)


def test_epsilon_join_against_brute_force(spark):
    pts = np.random.default_rng(2).standard_normal((60, 3))
    d = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    ref = {(i, j) for i in range(60) for j in range(60) if i != j and d[i, j] <= 1.0}
    got = {(r["src"], r["dst"]) for r in V.epsilon_join(frame(spark, pts), 1.0, metric="euclidean").collect()}
    assert got == ref


def test_connected_components_union_find(spark):
    edges = [(1, 2), (2, 3), (4, 5), (7, 8), (8, 9), (9, 10), (10, 11)]
    verts = spark.createDataFrame([(i,) for i in range(1, 13)], "id long")
    e = spark.createDataFrame(edges + [(b, a) for a, b in edges], "src long, dst long")
    got = {r["id"]: r["label"] for r in V.connected_components(verts, e).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 7, 10: 7, 11: 7, 12: 12}


def test_density_clusters_recover_planted(spark):
    pts, truth = planted()
    out = {r["vec_id"]: r["cluster_id"] for r in V.density_clusters(frame(spark, pts), 1.0, 5, metric="euclidean").collect()}
    ids = [out[i] for i in range(len(pts))]
    sizes = {c: ids.count(c) for c in set(ids) if c != -1}
    assert all(s >= 5 for s in sizes.values())
    # Each planted cluster maps to exactly one cluster id; noise is outlying.
    for c in range(4):
        members = {ids[i] for i, t in enumerate(truth) if t == c}
        assert len(members) == 1 and -1 not in members
    assert all(ids[i] == -1 for i, t in enumerate(truth) if t == -1)


def test_reduce_dims(spark):
    pts, _ = planted()
    out = V.reduce_dims(frame(spark, pts), 10).collect()
    assert len(out) == len(pts) and all(len(r["reduced"]) == 10 for r in out)


def test_star_forest_keeps_connectivity():
    rng = np.random.default_rng(4)
    src = rng.integers(0, 40, 120)
    dst = rng.integers(0, 40, 120)
    a, b = V._star_forest(src, dst)

    def comps(s, d):
        parent = {}

        def find(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for u, v in zip(s, d):
            parent[find(u)] = find(v)
        nodes = set(s) | set(d)
        return {frozenset(n for n in nodes if find(n) == find(m)) for m in nodes}

    assert comps(list(src), list(dst)) == comps(list(a), list(b)) | {frozenset([n]) for n in set(src) | set(dst) if n not in set(a) | set(b)}
    assert len(a) < len(set(src) | set(dst))


def test_knn_with_fewer_points_than_k(spark):
    pts = np.random.default_rng(9).standard_normal((6, 4))
    got = V.knn_join(frame(spark, pts), 15, metric="euclidean").collect()
    assert len(got) == 6 * 5 and {r["rank"] for r in got} == set(range(1, 6))


def test_blocks_are_sent_once_to_a_task(spark):
    pts = np.random.default_rng(3).standard_normal((3000, 24))  # nearly all blocks meet
    blocks = N.own_bounds(N.lay_out(V._points(frame(spark, pts), "vec_id", "embedding", "cosine"), 15), 15)
    table = blocks.table
    pairs = N.meeting(blocks, table.selectExpr("block", "centre", "radius + array_max(bounds) AS look"))
    rows, columns = N.grid(blocks, 2 * spark.sparkContext.defaultParallelism)
    sent = N.dealt(blocks, pairs, table.select(*N.SIDE, "bounds"), table.select(*N.SIDE, "centre", "radius"))
    n = table.count()
    assert pairs.count() > n * (rows + columns) >= sent.count()
    u = pts / np.linalg.norm(pts, axis=1, keepdims=True)
    d = 1 - u @ u.T
    np.fill_diagonal(d, np.inf)
    got = V.knn_join(frame(spark, pts), 15).groupBy("src").agg({"dst": "collect_set"}).collect()
    assert {r[0]: set(r[1]) for r in got} == {i: set(np.argsort(d[i])[:15].tolist()) for i in range(len(pts))}


def test_chunks_hold_every_header():
    have = {0: 5, 2: 2040, 3: 10, 7: 3 * N.PROBES + 1, 9: 1}
    cells, chunks, of = N._chunks(have)
    assert (np.diff(chunks) >= 0).all() and set(zip(cells.tolist(), chunks.tolist())) == {(c, a + k) for c, (a, n) in of.items() for k in range(n)}
    assert of[7][1] == 4 and not {c for c, at in zip(cells, chunks) if c != 7} & {7} and set(chunks.tolist()) == set(range(max(chunks) + 1))


def test_knn_search_answers_once_for_each_point_and_task(spark):
    pts = np.random.default_rng(5).standard_normal((2000, 16))
    blocks = N.lay_out(V._points(frame(spark, pts), "vec_id", "embedding", "cosine"), 5)
    _, columns = N.grid(blocks, 2 * spark.sparkContext.defaultParallelism)
    assert N.within(blocks, "cosine", 5).count() <= 5 * 2000 * columns


def tile_block(x, ids, bound):
    centre = x.mean(axis=0)
    return {"n": len(x), "ids": ids, "rows": x, "centre": centre, "radius": float(np.sqrt(((x - centre) ** 2).sum(1).max())), "bounds": np.full(len(x), bound)}


@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e25])
def test_tile_of_nearest_against_brute_force(scale):
    """Also far from the origin, with ties and copies, and beyond float32's range."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.standard_normal((300, 7)), rng.integers(0, 3, (300, 7)) + 100.0]) * scale
    ids = rng.permutation(len(x)).astype(np.int64)
    d = N.exact(x, x, "euclidean")[1]
    tile = N.Nearest([tile_block(x[a : a + 100], ids[a : a + 100], np.inf) for a in (0, 300)], (x.mean(axis=0), 200.0 * scale), 1e-6 * scale, "euclidean", 6)
    for a in range(0, 600, 75):
        tile.look(tile_block(x[a : a + 75], ids[a : a + 75], np.inf))
    src, dst, dist = tile.last()
    at = [*range(100), *range(300, 400)]
    want = {(int(ids[i]), int(ids[j])) for i in at for j in [j for j in np.lexsort((ids, d[i])) if j != i][:6]}
    assert set(zip(src.tolist(), dst.tolist())) == want and np.isfinite(dist).all()


def test_points_that_meet_the_largest_component_are_done():
    x = np.random.default_rng(7).uniform(0, 1, (4000, 3))
    ids = np.arange(4000)
    tile = N.Forest([tile_block(x[:2000], ids[:2000], 0.5)], (x.mean(axis=0), 2.0), 1e-6, "euclidean")
    compared, near = [], tile.near

    def counted(at, came, columns=None):
        compared.append(len(at) * len(came.y if columns is None else columns))
        return near(at, came, columns)

    tile.near = counted
    for a in range(2000, 4000, 200):
        tile.look(tile_block(x[a : a + 200], ids[a : a + 200], 0.5))
    src, dst = tile.last()
    assert len(src) == 3999 and sum(compared) < 2000 * 2000 / 2
    assert len({(a, b) for a, b in zip(*V._star_forest(src, dst))}) == 3999
