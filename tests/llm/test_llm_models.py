import zlib

import numpy as np
import pytest

from tessera.llm import quality, toxicity
from tessera.llm.common import documents


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def area(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    a = y == 1
    return (rank[a].sum() - a.sum() * (a.sum() - 1) / 2) / (a.sum() * (~a).sum())


# Quality ----------------------------------------------------------------------
def test_isotonic_by_hand():
    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 0.6, 0.4, 0.4, 1.0]), np.array([1.0, 1, 1, 2, 1]))
    assert y.tolist() == pytest.approx([0, 0.45, 1]) and x.tolist() == pytest.approx([0, 2.25, 4])
    x, y = quality.isotonic(np.arange(3.0), np.array([3.0, 2, 1]), np.ones(3))
    assert y.tolist() == [2.0]


def test_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(0)
    d = len(quality.STATISTICS)
    w, b = rng.normal(size=(d, 20000)) / (quality.WIDTH * np.sqrt(d)), rng.uniform(0, 2 * np.pi, 20000)
    model = quality.KernelModel(np.zeros(d), np.ones(d), w, b, None, None, None)
    x = rng.normal(size=(6, d))
    z = model.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * quality.WIDTH**2 * d))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_partition_sums_are_the_whole(spark):
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    x, y, fold = rng.normal(size=(200, d)), rng.integers(0, 2, 200).astype(float), rng.integers(0, 4, 200)
    model = quality.KernelModel(np.zeros(d), np.ones(d), rng.normal(size=(d, 20)), rng.uniform(size=20), np.zeros(21), np.zeros(1), np.zeros(1))
    df = spark.createDataFrame([(x[i].tolist(), float(y[i]), int(fold[i])) for i in range(200)], "x array<double>, y double, fold long").repartition(7)
    z = model.features(x)
    for f, got in enumerate(quality._sums(df, model, 4)):
        here = fold == f
        assert np.allclose(got, z[here].T @ np.column_stack([z, y])[here])


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    import __spark_entry__

    got = {r.doc_id: r for r in __spark_entry__.queries()["op9_quality"](spark, sf).collect()}
    assert len(got) == documents(spark, sf).count()
    assert all(r.held_out == held(k) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for k, r in got.items())
    rows = [(got[r.doc_id].score, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if held(r.doc_id)]
    score, y = map(np.array, zip(*rows, strict=True))
    assert area(score, y) > 0.97 and ((score >= 0.3) == y).mean() > 0.93


def test_quality_edges(spark, edge, none, rows):
    marked = [(k, k % 2) for k in range(0, 30)] + [(None, 1), (5, None), (4, 7), (9999, 1), (6, 0), (6, 0)]
    labels = spark.createDataFrame(marked, "doc_id long, quality int")
    stats = quality.with_statistics(edge)
    model = quality.fit(stats, labels)
    got = quality.score(stats, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows) and all(0 <= r.score <= 1 for r in got)
    kept = quality.drop_poor(edge, model, 0.3)
    assert kept.columns == edge.columns and kept.count() == sum(r.score >= 0.3 for r in got)
    nothing = quality.fit(stats, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(stats, nothing).collect()} == {0.5}
    one = quality.fit(stats, spark.createDataFrame([(k, 1) for k in range(30)], "doc_id long, quality int"))
    assert min(r.score for r in quality.score(stats, one).collect()) > 0.9
    empty = quality.with_statistics(none)
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0 and quality.drop_poor(none, nothing).count() == 0


# Toxicity -----------------------------------------------------------------------
def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 80, 81, 500):
        w = toxicity.windows(n)
        assert w[0] == 0 and w[-1] + toxicity.WINDOW >= n and (len(w) == 1 or w[-2] + toxicity.WINDOW < n)
        assert (np.diff(w) < toxicity.WINDOW).all()
    ids, of = toxicity.window_table([np.arange(1, 100), np.zeros(0, dtype=int), np.array([7])])
    assert of.tolist() == [0, 0, 0, 1, 2] and set(ids[of == 0].ravel()) == set(range(100)) and ids[4].sum() == 7 and ids[3].sum() == 0


def test_gradient_against_differences():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = toxicity.Words()
    ids, of = toxicity.window_table([words.numbers(t.split()) for t in ("foo bar baz " * 20, "some other words")])
    own, flat, begin = words.buckets()
    y = (of == 0).astype(float)
    _, g = net.gradient(own, flat, begin, ids, y)
    for name, d in g.items():
        if isinstance(d, tuple):  # a table: the sum over a row's uses
            at = (int(d[0][-1]), 2)
            exact = d[1][d[0] == at[0], at[1]].sum()
        else:
            at = tuple(n // 2 for n in d.shape)
            exact = d[at]
        old, ends = net.p[name][at], []
        for e in (1e-3, -1e-3):
            net.p[name][at] = old + e
            ends.append(net.gradient(own, flat, begin, ids, y)[0])
        net.p[name][at] = old
        assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(exact, rel=0.05, abs=1e-7), name


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"  # the smaller tables mark a few toxic rows in each of four languages
    import __spark_entry__

    got = {r.doc_id: r for r in __spark_entry__.queries()["op4_toxicity"](spark, sf).collect()}
    assert len(got) == documents(spark, sf).count()
    assert all(r.held_out == held(k) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for k, r in got.items())
    rows = [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if held(r.doc_id)]
    score, y = map(np.array, zip(*rows, strict=True))
    assert area(score, y) > 0.93 and (score[y == 1] >= 0.5).mean() > 0.8 and (score[y == 0] < 0.5).mean() > 0.97


def test_network_learns_stems_and_finds_them_in_long_texts():
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 8)))
    text = lambda n, bad: " ".join(("zork" + word()) if bad and k in (n // 2, n // 3) else word() for k in range(n))
    y = np.arange(240) % 2
    net = toxicity.train([text(60 + k % 50, bool(k % 2)) for k in range(240)], y.astype(np.float32))
    scorer = toxicity.Scorer(net)
    new = [text(80, False) for _ in range(40)] + [text(80, True) for _ in range(40)]
    score = scorer.scores(new)
    assert area(score, np.repeat([0, 1], 40)) > 0.95
    far = scorer.scores([text(3000, True), ""])
    assert far[0] > 0.5 > far[1]


def test_long_words_are_read_to_their_end():
    text = "".join(chr(0x4E00 + k) for k in range(1000))
    for t in (text, text[:65], text[:64], "a " + text + " b", ""):
        words = toxicity.split_words(t)
        grams = lambda ws: {w[i : i + 4] for w in ws for i in range(len(w) - 3)}
        assert grams(words) == grams(t.split()) and set("".join(words)) == set("".join(t.split())) and all(len(w) <= 64 for w in words)
    rng = np.random.default_rng(2)
    run = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    y = np.arange(240) % 2
    net = toxicity.train([run(300) + ("zorkzorkzork" if k % 2 else "") + run(300) for k in range(240)], y.astype(np.float32))
    score = toxicity.Scorer(net).scores([run(1500) + "zorkzorkzork" * (k % 2) + run(1500) for k in range(40)])
    assert area(score, np.arange(40) % 2) > 0.95


def test_scores_follow_the_true_ratio_in_any_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "one and the same text") for k in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(3000)], "doc_id long, toxic int")
    scores = []
    for most in (5000, 100):
        monkeypatch.setattr(toxicity, "SAMPLE", most)
        scores.append(toxicity.score_toxicity(docs, labels).first().score)
    assert all(0.07 < s < 0.13 for s in scores), scores


def test_sample_is_bounded_in_rows_and_code_points(spark, monkeypatch):
    """A prefix of each label in hash order; repeated ids give one text each."""
    docs = spark.createDataFrame([(k, "word " * 20 + str(r)) for k in range(200) for r in range(1 + 9 * (k % 4 == 0))], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    texts, y, stands = toxicity.sample(docs, labels, "toxic")
    learnable = sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(200))
    assert len(texts) == len(y) == learnable and stands == (1, 1)
    monkeypatch.setattr(toxicity, "SAMPLE_TOTAL", 1000)
    texts, y, stands = toxicity.sample(docs, labels, "toxic")
    assert [int((y == v).sum()) for v in (0, 1)] == [9, 9] and all(9 * len(t) <= 1000 for t in texts)
    assert sum(s * 9 for s in stands) == pytest.approx(learnable)


def test_toxicity_edges(spark, edge, none, rows):
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(edge, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows) and all(0 <= r.score <= 1 for r in got)
    same = toxicity.score_toxicity(edge, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert len({r.score for r in same}) == 1
    assert toxicity.score_toxicity(none, labels).count() == 0
