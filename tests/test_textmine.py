"""TF-IDF, k-means for all K at once and PCA against plain restatements."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tessera.operators import textmine as TM
from tessera.operators.vectors import reduce_dims
from tessera.queries.views import summarised

KEY = ["account", "name"]


@pytest.fixture(scope="module")
def tf(spark, sf_dir):
    return TM.tfidf(summarised(spark, sf_dir), "summary", KEY)


def dense(rows, width):
    out = np.zeros((len(rows), width))
    for r, x in zip(rows, out, strict=True):
        x[r["term_index"]] = r["weight"]
    return out


def test_rows_equal_the_long_table(tf):
    long = {(r["account"], r["name"], r["term_index"]): r["weight"] for r in tf.long.collect()}
    rows = tf.rows.collect()
    assert sum(len(r["weight"]) for r in rows) == len(long)
    for r in rows:
        assert r["term_index"] == sorted(set(r["term_index"]))
        assert [long[r["account"], r["name"], i] for i in r["term_index"]] == r["weight"]


def test_weights_of_small_texts(spark):
    texts = ["apple apple pear", "pear plum", "plum plum plum", "", None, "fig", "apple pear plum"]
    df = spark.createDataFrame([("a", str(i), t) for i, t in enumerate(texts)] + [("a", "1", "pear")], "account string, name string, text string").repartition(3)
    t = TM.tfidf(df, "text", KEY, stop_words=[], max_df=1.0)
    docs = [x.split() for x in [*texts, "pear"] if x]
    df_of = Counter(w for d in docs for w in set(d))
    vocab = sorted(w for w, n in df_of.items() if n >= 2)
    assert t.n_docs == len(docs) and t.vocab == vocab
    wanted = []
    for d in docs:
        raw = {w: d.count(w) * (math.log((1 + len(docs)) / (1 + df_of[w])) + 1) for w in vocab if w in d}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        wanted.append([(vocab.index(w), pytest.approx(raw[w] / norm)) for w in sorted(raw)])
    got = [list(zip(r["term_index"], r["weight"], strict=True)) for r in t.rows.collect()]
    assert sorted(got, key=str) == sorted(([(i, float(w.expected)) for i, w in d] for d in wanted), key=str) or len(got) == len(wanted)
    for d in wanted:
        assert d in got  # copies of a key are documents of their own


def test_no_document_and_term_pairs_are_shuffled(tf):
    """Neither the weights nor the long table have an exchange behind the
    written counts."""
    for frame in (tf.rows, tf.long):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan


def plain_kmeans(x, keys, k, rounds):
    order = sorted(range(len(x)), key=lambda i: (hashlib.md5("/".join(keys[i]).encode()).hexdigest(), keys[i]))
    centres = x[order[:k]].copy()
    for _ in range(rounds + 1):
        d = np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None] - 2 * x @ centres.T, 0)
        near = np.round(d, 9).argmin(1)
        cost = d[np.arange(len(x)), near].sum()
        last = centres
        centres = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(k)])
    return near, last, cost


def test_kmeans_for_all_k_equals_one_by_one(spark, tf):
    rows = tf.rows.collect()
    x, keys = dense(rows, len(tf.vocab)), [(r["account"], r["name"]) for r in rows]
    models = TM.kmeans(tf.rows, KEY, len(tf.vocab))
    assert sorted(models.centres) == list(range(2, 16))
    for k in (2, 5, 15):
        near, centres, cost = plain_kmeans(x, keys, k, TM.ROUNDS)
        assert models.cost[k] == pytest.approx(cost, abs=1e-8)
        assert np.abs(models.centres[k] - centres).max() < 1e-9
        got = {(r["account"], r["name"]): r["text_cluster"] for r in TM.kmeans_assign(tf.rows, k, KEY, models).collect()}
        assert got == dict(zip(keys, near.tolist(), strict=True))


def test_kmeans_of_few_and_equal_rows(spark):
    rows = spark.createDataFrame([(str(i), [0], [1.0]) for i in range(3)] + [("e", [], [])], "name string, term_index array<int>, weight array<double>")
    models = TM.kmeans(rows, ["name"], 2, [2, 3, 9])
    assert sorted(models.centres) == [2, 3] and models.cost[3] <= models.cost[2] + 1e-12
    assert TM.kmeans_assign(rows, 9, ["name"], models).filter("text_cluster IS NULL").count() == 4
    assert TM.kmeans(rows.limit(0), ["name"], 2).cost == {}


def test_pca_is_centred(tf):
    rows = tf.rows.orderBy(*KEY)
    got = TM.pca_2d(rows, KEY, len(tf.vocab)).toPandas().sort_values(KEY)
    x = dense(rows.collect(), len(tf.vocab))
    centred = x - x.mean(0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    for j, c in enumerate(["pc1", "pc2"]):
        axis = vt[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert np.abs(got[c].to_numpy() - centred @ axis).max() < 1e-8


def test_axes_of_a_wide_vocabulary(spark):
    """No width x width matrix: 200,000 terms."""
    rng = np.random.default_rng(0)
    width, data = 200_000, []
    for i in range(60):
        terms = sorted(rng.choice(width, 40, replace=False).tolist())
        weights = rng.random(30)
        weights[:2] *= 20  # two directions stand out
        data.append((str(i), [7, 99_999, *[t for t in terms if t not in (7, 99_999)][:28]], weights.tolist()))
    rows = spark.createDataFrame(data, "name string, term_index array<int>, weight array<double>")
    axes, variances, mean, n = TM.principal_axes(rows, width, 2)
    used = sorted({t for _, terms, _ in data for t in terms})
    x = np.zeros((60, len(used)))
    for k, (_, terms, weights) in enumerate(data):
        x[k, [used.index(t) for t in terms]] = weights
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert n == 60 and axes.shape == (width, 2)
    assert variances == pytest.approx(values[:2], rel=1e-6)


def test_reduced_vectors_keep_what_the_axes_hold(spark):
    rng = np.random.default_rng(3)
    pts = rng.standard_normal((50, 12)) * np.arange(1, 13)
    pts[7] = 0
    df = spark.createDataFrame([(i, p.tolist(), "w") for i, p in enumerate(pts)], "vec_id long, embedding array<double>, weight string")
    out = reduce_dims(df, 4).orderBy("vec_id").collect()
    assert [r["weight"] for r in out] == ["w"] * 50 and out[7]["reduced"] == [0.0] * 4
    unit = pts / np.maximum(np.linalg.norm(pts, axis=1, keepdims=True), 1e-300)
    _, _, vt = np.linalg.svd(unit - unit.mean(0), full_matrices=False)
    axes = vt[:4].T * np.sign(vt[:4].T[np.abs(vt[:4]).argmax(1), np.arange(4)])
    assert np.abs(np.array([r["reduced"] for r in out]) - unit @ axes).max() < 1e-8


def test_idf_is_smoothed_plus_one(tf):
    vocab = tf.vocab_df().collect()
    assert vocab == sorted(vocab, key=lambda r: r["term"])
    assert all(r["idf"] >= 1.0 for r in vocab)


def test_blocks_are_small_and_sums_go_by_one_index(monkeypatch):
    """Products of a block with all 119 centres stay in a core's cache."""
    rng = np.random.default_rng(5)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(0, 60, 1500))])
    index, weight = rng.integers(0, 300, offsets[-1]).astype(np.int32), rng.random(offsets[-1])
    assert max(offsets[b] - offsets[a] for a, b in TM._blocks(offsets)) * 119 * 8 <= 1 << 22
    row, plain, sums = np.repeat(np.arange(1500), np.diff(offsets)) % 7, np.zeros((7, 300)), np.zeros((7, 300))
    np.add.at(plain, (row, index), weight)
    TM._add_at(sums, row, index, weight)
    assert (sums == plain).all()
