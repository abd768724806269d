"""Repeated and null keys, one model call a row, exact waves, copies among
vectors, verified rewrites and resumed jobs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import stubs
from tessera.operators import filters as P
from tessera.operators import joins as J
from tessera.operators import sets as U
from tessera.operators import vectors as V
from tessera.plans.batch import embed_pending
from tessera.plans.classify import classify_goals, classify_open_vocab
from tessera.plans.reports import goal_report
from tessera.plans.scan import scan_job
from tessera.plans.summarise import summarise, summarise_job
from tessera.session import shared_path
from tessera.sources import ingest
from tessera.sources import catalogue as store
from tessera.sources.catalogue import overwrite_and_verify, read_table


def counting(path, model):
    """A factory whose model leaves a line in a local file for each call (tests
    run in local mode, where tasks share the machine)."""

    def factory():
        inner = model()

        def call(x):
            with open(path, "a") as f:
                f.write("x\n" * (len(x) if isinstance(x, list) else 1))
            return inner(x)

        return call

    return factory


def calls(path):
    return sum(1 for _ in open(path)) if os.path.exists(path) else 0


ROWS = [("a", "x", "done one", [1.0, 0.0]), ("a", "x", "pending", None), (None, "n", "null key", None), ("b", "y", "other", None), ("b", "z", None, None)]


def test_embed_pending_keeps_every_row(spark):
    df = spark.createDataFrame(ROWS, "account string, name string, summary string, embedding array<double>")
    got = embed_pending(df, stubs.hash_embedding(2)).collect()
    assert sorted(str(r["summary"]) for r in got) == sorted(str(r[2]) for r in ROWS)
    by = {r["summary"]: r["embedding"] for r in got}
    assert by["done one"] == [1.0, 0.0] and by[None] is None and all(len(by[k]) == 2 for k in ("pending", "null key", "other"))


def test_key_joins_keep_the_number_of_rows(spark):
    left = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), (None, "x", 3)], "account string, name string, n int")
    right = spark.createDataFrame([("a", "x", "t2"), ("a", "x", "t1"), (None, "x", "t3")], "account string, name string, topic string")
    assert [(r["n"], r["topic"]) for r in J.assign_topic(left, right).orderBy("n").collect()] == [(1, "t1"), (2, "t1"), (3, "Uncategorized")]
    clusters = right.select("account", "name", F.length("topic").alias("text_cluster"))
    assert J.attach_clusters(left, clusters).count() == 3
    assert U.merge_results(left, right.withColumnRenamed("topic", "summary")).count() == 3
    readmes = spark.createDataFrame([("a", "x", 404, None), ("a", "x", 200, "text"), ("a", "x", 200, "text")], "account string, name string, status int, body string")
    assert [r["readme_snippet"] for r in J.attach_readme(left, readmes).orderBy("n").collect()] == ["text", "text", "README not available"]


def catalogue(spark, n=40):
    return spark.range(n).select(F.lit("acc").alias("account"), F.concat(F.lit("r"), "id").alias("name"), F.lit("d").alias("description"), F.concat(F.lit("text "), "id").alias("readme"),
                                 F.when(F.col("id") % 4 == 0, "done").alias("summary"), F.timestamp_seconds(F.col("id") % 3).alias("created_at"))


def test_one_call_for_each_pending_row(spark, tmp_path):
    path = str(tmp_path / "calls")
    out = summarise(catalogue(spark), stubs.SUMMARY_TEMPLATE, counting(path, stubs.first_words(3))).collect()
    assert calls(path) == 30 and sum(r["summary"] == "done" for r in out) == 10 and len(out) == 40
    path = str(tmp_path / "goals")
    goals = [g["name"] for g in stubs.GOALS]
    scored = classify_goals(catalogue(spark).withColumn("summary", F.coalesce("summary", "readme")), stubs.GOAL_TEMPLATE, stubs.GOALS, counting(path, stubs.goal_answer(goals)))
    frames = goal_report(scored, [g.replace(" ", "_").lower() for g in goals])
    assert all(f.count() >= 0 for f in frames.values()) and calls(path) == 40
    path = str(tmp_path / "topics")
    rows, vocab = classify_open_vocab(catalogue(spark), stubs.TOPIC_TEMPLATE, counting(path, stubs.seed_topic(("text",))), ["text"], waves=[5, 7])
    assert rows.count() == 40 and vocab.count() >= 1 and calls(path) == 40


def test_waves_are_exact_among_equal_times(spark):
    df = spark.range(200).select(F.lit("a").alias("account"), F.lit("same").alias("name"), F.concat(F.lit("w"), "id").alias("summary"), F.lit(None).cast("timestamp").alias("created_at"))
    seen = classify_open_vocab(df, stubs.TOPIC_TEMPLATE, stubs.seed_topic((), use_prompt_list=True), [], waves=[1, 1, 1])
    assert seen[0].count() == 200
    ordered, counts = U.in_order(df, "created_at")
    assert sum(counts.values()) == 200
    for rank in (0, 1, 57, 199):
        assert ordered.filter(F.col("__place") < U.place_of(rank, counts)).count() == rank
    assert sorted(r[0] for r in ordered.select(U.place_rank(counts)).collect()) == list(range(200))


def test_copies_among_vectors(spark):
    base = np.random.default_rng(4).standard_normal((3, 8))
    pts = [(i, base[i % 3].tolist()) for i in range(120)]
    df = spark.createDataFrame(pts, "vec_id long, embedding array<double>")
    for metric in ("cosine", "euclidean"):
        got = V.epsilon_join(df, 0.0, metric=metric)
        assert got.count() == 3 * 40 * 39
        near = {}
        for r in V.knn_join(df, 5, metric=metric).orderBy("src", "rank").collect():
            near.setdefault(r["src"], []).append(r["dst"])
        assert near == {i: [j for j in range(120) if j % 3 == i % 3 and j != i][:5] for i in range(120)}


def test_scores_that_are_no_numbers(spark):
    df = spark.createDataFrame([("NaN",), ("4d",), (" 4.5 ",), ("1e2",), ("0x1",), ("-3",), ("Infinity",), (None,), ("5.",)], "s string")
    assert [r["s"] for r in P.to_score(df, ["s"]).collect()] == [None, None, 4.5, 100.0, None, -3.0, None, None, 5.0]


def test_rewrite_is_checked_before_the_swap(spark):
    path = shared_path(spark, "rewrite")
    spark.range(10).write.parquet(path)
    reject = F.col("id") >= 7
    with pytest.raises(RuntimeError):  # keep and reject don't complement each other
        overwrite_and_verify(spark, path, F.col("id") < 9, reject)
    assert read_table(spark, path).count() == 10
    assert overwrite_and_verify(spark, path, ~reject, reject)["after"] == 7


def test_rewrite_touches_only_files_with_rejected_rows(spark, monkeypatch):
    path = shared_path(spark, "rewrite")
    spark.range(0, 100, 1, 5).withColumn("part", F.col("id") % 2).write.partitionBy("part").parquet(path)
    files = lambda: {f"{folder}/{n}" for folder, names in store._parts(spark, path) for n in names}
    old, reject = files(), F.col("id") < 10
    switch = store._switch

    def lost(*_):
        raise ConnectionError("the driver is gone")

    monkeypatch.setattr(store, "_switch", lost)
    with pytest.raises(ConnectionError):
        overwrite_and_verify(spark, path, ~reject, reject)
    assert files() == old and read_table(spark, path).count() == 100  # the old table
    monkeypatch.setattr(store, "_switch", switch)
    done = overwrite_and_verify(spark, path, ~reject, reject)
    assert (done["after"], done["rewritten"]) == (90, 2) and len(old & files()) == len(old) - 2
    assert {(r["id"], r["part"]) for r in read_table(spark, path).collect()} == {(i, i % 2) for i in range(10, 100)}
    # Rows that come later count, and rewrites follow one another.
    spark.range(3).withColumn("part", F.lit(7).cast("long")).write.mode("append").partitionBy("part").parquet(path)
    assert read_table(spark, path).count() == 93
    again = overwrite_and_verify(spark, path, F.col("id") >= 12, F.col("id") < 12)
    assert again["after"] == 88 and again["before"] == 93
    assert overwrite_and_verify(spark, path, F.col("id") >= 12, F.col("id") < 12)["rewritten"] == 0
    assert store.drop_replaced(spark, path) == 5 and read_table(spark, path).count() == 88


def test_scan_job_fails_on_a_table_it_cannot_read(spark, tmp_path):
    bad = tmp_path / "catalogue"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    empty = spark.createDataFrame([], "account string, page long, body string")
    registry = spark.createDataFrame([("g", ["a"])], "group string, accounts array<string>")
    readmes = spark.createDataFrame([], "account string, name string, status int, body string")
    with pytest.raises(Exception):  # noqa: B017
        scan_job(registry, empty, readmes, str(bad))
    assert scan_job(registry, empty, readmes, str(tmp_path / "new")) == 0


def test_bad_registry_and_listing_records(spark, tmp_path):
    (tmp_path / "registry.json").write_text("[1, 2]")
    with pytest.raises(Exception, match="not a mapping"):
        ingest.read_registry(spark, str(tmp_path / "registry.json")).collect()
    lines = ['{"account": "a", "page": 0, "body": "[{\\"name\\": \\"x\\"}]"}', "not json", '{"account": "b", "page": 1, "body": "{}"}']
    (tmp_path / "listing.json").write_text("\n".join(lines))
    path = str(tmp_path / "listing.json")
    assert ingest.read_listing(spark, path).count() == 1
    assert sorted(r["record"] for r in ingest.corrupt_listing(spark, path).collect()) == ["not json", "{}"]


def test_summary_job_goes_on_where_it_stopped(spark, tmp_path):
    out, path = shared_path(spark, "summaries"), str(tmp_path / "calls")
    rows = catalogue(spark).drop("summary")
    summarise_job(rows.filter(F.col("name") < "r2"), out, "run", stubs.SUMMARY_TEMPLATE, counting(path, stubs.first_words(9)))
    first = calls(path)
    summarise_job(rows, out, "run", stubs.SUMMARY_TEMPLATE, counting(path, stubs.first_words(9)))
    assert calls(path) == 40 and 0 < first < 40
    whole = shared_path(spark, "summaries")
    summarise_job(rows, whole, "run", stubs.SUMMARY_TEMPLATE, stubs.first_words(9))
    pick = lambda p: sorted((r["name"], r["summary"]) for r in spark.read.parquet(p).collect())
    assert pick(out) == pick(whole)
