"""Aggregations, windows and top-k against small brute-force checks."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators import aggregates as A
from tessera.operators import topk as T
from tessera.operators import windows as W


# Inertia for K = 2, 3, ..., and the K worked out by hand: the sharpest bend,
# that is the largest change from one step down to the next, the first of equals.
ELBOWS = [
    ([10.0], 2),
    ([10.0, 8.0], 2),
    ([100.0, 60.0, 50.0, 45.0, 43.0], 3),  # steps -40 -10 -5 -2: bends 30 5 3 at K = 3 4 5
    ([100.0, 90.0, 40.0, 35.0, 34.0], 4),  # steps -10 -50 -5 -1: bends -40 45 4
    ([100.0, 95.0, 90.0, 30.0, 28.0, 27.0], 5),  # steps -5 -5 -60 -2 -1: bends 0 -55 58 1
    ([9.0, 7.0, 5.0, 3.0], 3),  # bends 0 0
    ([5.0, 4.0, 4.0, 3.0, 3.0, 1.0], 3),  # steps -1 0 -1 0 -2: bends 1 -1 1 -2
]


@pytest.mark.parametrize("inertia, k", ELBOWS)
def test_elbow(spark, inertia, k):
    df = spark.createDataFrame([(2 + i, v) for i, v in enumerate(inertia)], "k int, inertia double")
    assert W.elbow(df).first()["k"] == k


def test_elbow_empty(spark):
    assert W.elbow(spark.createDataFrame([], "k int, inertia double")).first()["k"] == 2


def test_limit_top_no_limit_values(spark):
    df = spark.createDataFrame([("a", str(i), i) for i in range(5)], "account string, name string, stars long")
    for n in (None, 0, -1):
        assert T.limit_top(df, n, "stars").count() == 5
    assert [r["stars"] for r in T.limit_top(df, 2, "stars").collect()] == [4, 3]
    assert T.limit_top(df, 2, "missing_column").count() == 2


def test_describe_numeric_matches_pandas(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, None]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    got = A.describe_numeric(df, ["x"]).first()
    ref = pd.Series(vals, dtype="float").describe()
    assert got["count"] == ref["count"]
    for a, b in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert got[a] == pytest.approx(ref[b])


def test_order_statistics_without_a_sort(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1e-9, 300), rng.normal(0, 1e200, 300), np.repeat([2.5, -0.0, 0.0], 50), [np.inf, -np.inf, 5e-324]])
    y = rng.integers(-3, 3, len(x)).astype(float)
    df = spark.createDataFrame([(float(a), None if i % 9 == 0 else float(b), None) for i, (a, b) in enumerate(zip(x, y))], "x double, y double, z double").repartition(5)
    ranks = [list(range(0, len(x), 7)), [0, 5, 100, 600], []]
    got = A.order_statistics(df, ranks)
    order = [np.sort(x), np.sort([b for i, b in enumerate(y) if i % 9])]
    for found, at, wanted in zip(got, ranks, order):
        assert [found[r] for r in at] == [wanted[r] for r in at]
    assert got[2] == {}
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert np.isnan(A.order_statistics(nan, [[1]])[0][1])


def test_unique_vs_total_counts_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, "x")], "account string, name string")
    r = A.unique_vs_total(df, ["account", "name"]).first()
    assert (r["unique_keys"], r["total_rows"]) == (3, 4)
    assert W.duplicate_rows(df).count() == 2


def test_score_histogram_and_total(spark):
    df = spark.createDataFrame([("a", "1", 4.5, None), ("a", "2", 0.0, 5.0), ("a", "3", None, None)],
                               "account string, name string, g1_score double, g2_score double")
    h = {(r["goal"], r["score_bin"]): r["count"] for r in A.score_histogram(df, ["g1", "g2"]).collect()}
    assert h[("g1", 4)] == 1 and h[("g1", 0)] == 1 and h[("g2", 5)] == 1 and h[("g2", 3)] == 0
    tot = {r["name"]: r["t"] for r in df.select("name", A.total_score(["g1_score", "g2_score"]).alias("t")).collect()}
    assert tot == {"1": 4.5, "2": 5.0, "3": 0.0}


def test_top_per_goal_order(spark):
    rows = [("a", "1", 5.0, "2020-01-01"), ("a", "2", 5.0, "2021-01-01"), ("a", "3", 0.0, "2022-01-01"),
            ("a", "4", 3.0, None), ("a", "5", 3.0, "2019-01-01")]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "account string, name string, g_score double, created_at string") \
        .withColumn("created_at", F.col("created_at").cast("timestamp"))
    got = [r["name"] for r in W.top_per_goal(df, ["g"], 3).orderBy("goal_rank").collect()]
    assert got == ["2", "1", "5"]


def test_sample_per_group_reproducible(spark):
    df = spark.createDataFrame([("a", str(i), i % 3) for i in range(30)], "account string, name string, c int")
    s1 = sorted((r["c"], r["name"]) for r in W.sample_per_group(df, "c", 5, 42).collect())
    s2 = sorted((r["c"], r["name"]) for r in W.sample_per_group(df, "c", 5, 42).collect())
    s3 = sorted((r["c"], r["name"]) for r in W.sample_per_group(df, "c", 5, 7).collect())
    assert s1 == s2 and len(s1) == 15 and s1 != s3
