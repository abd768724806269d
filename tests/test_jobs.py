"""Whole jobs on hand-made frames: empty and degenerate inputs."""

from pyspark.sql import functions as F

from tessera import stubs
from tessera.plans.batch import classify_batch
from tessera.plans.reports import goal_report, reprocess
from tessera.plans.topics import topic_report
from tessera.schemas import README_MISSING, UNCATEGORIZED

SCHEMA = "account string, name string, summary string"


def test_batch_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    out, topics = classify_batch(df, stubs.hash_embedding(8), stubs.cluster_label(), stubs.LABEL_TEMPLATE)
    assert out.count() == 0 and "topic" in out.columns


def test_batch_without_any_vector_is_uncategorized(spark):
    # No summary at all: nothing can be embedded, every row is Uncategorized.
    df = spark.createDataFrame([("a", str(i), None) for i in range(6)], SCHEMA)
    out, topics = classify_batch(df, stubs.hash_embedding(8), stubs.cluster_label(), stubs.LABEL_TEMPLATE)
    assert {r["topic"] for r in out.collect()} == {UNCATEGORIZED}
    assert [r["topic"] for r in topics.collect()] == [UNCATEGORIZED]


def test_batch_reruns_on_classified_frame(spark):
    rows = [("a", str(i), f"project {i % 3} tools and data") for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("topic", F.lit("old"))
    out, topics = classify_batch(df, stubs.hash_embedding(8), stubs.cluster_label(), stubs.LABEL_TEMPLATE)
    assert out.count() == 12 and "old" not in {r["topic"] for r in out.collect()}
    assert UNCATEGORIZED in {r["topic"] for r in topics.collect()}


def test_topic_report_tiny_input(spark):
    df = spark.createDataFrame([("a", "1", "only one summary here", "x", "Go")],
                               "account string, name string, summary string, topic string, language string")
    rep = topic_report(df)
    assert rep["k"] == 0 and rep["clusters"] is None
    assert rep["headline_language"].first()["language"] == "Go"


def test_goal_report_frames(spark):
    df = spark.createDataFrame(
        [("a", "1", "s1", "4", "r", "0", "r"), ("a", "2", "s2", "junk", "r", "2.5", "r")],
        "account string, name string, summary string, g1_score string, g1_reason string, g2_score string, g2_reason string",
    )
    rep = goal_report(df, ["g1", "g2"])
    hist = {(r["goal"], r["score_bin"]): r["count"] for r in rep["histogram"].collect()}
    assert hist[("g1", 4)] == 1 and hist[("g2", 2)] == 1 and hist[("g2", 0)] == 1
    assert [r["name"] for r in rep["top_per_goal"].filter("goal = 'g1'").collect()] == ["1"]
    assert [r["name"] for r in rep["high_impact"].collect()] == ["1", "2"]


def test_reprocess_audit(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", README_MISSING), ("a", "1", "ok"), ("a", "2", None)],
                               "account string, name string, readme_snippet string")
    path = str(tmp_path / "cat")
    df.write.parquet(path)
    audit = reprocess(spark, path)
    assert audit["missing"]["missing"] == 1 and audit["duplicates"] == 2
    assert audit["unique_vs_total"] == {"unique_keys": 2, "total_rows": 3}
    assert audit["rewrite"]["remaining_rejected"] == 0 and audit["rewrite"]["after"] == 2


def test_topic_report_makes_its_rows_once(spark):
    """A model behind the input runs once for each row, whatever is read of the report."""
    calls = spark.sparkContext.accumulator(0)

    def answer(text):
        calls.add(1)
        return f"topic of {text[:4]}"

    model = F.udf(answer, "string").asNondeterministic()  # else a filter alone would ask it again

    words = ["stone river walks", "river stone falls", "green stone house", "green house garden", "garden walks falls", "house river garden"]
    rows = [("acc", str(i), words[i % 6], i, i) for i in range(24)]
    df = spark.createDataFrame(rows, "account string, name string, summary string, stars long, forks long")
    rep = topic_report(df.withColumn("topic", model("summary")), ks=[2, 3, 4])
    assert rep["topics_per_cluster"].count() > 0 and rep["top_topics"].count() == 5
    assert calls.value == 24


def test_classify_batch_writes_texts_once(spark, monkeypatch):
    from tessera.operators import vectors
    from tessera.plans import batch
    from tessera.session import cut_lineage

    written = []

    def cut(df):
        written.append(df.schema.simpleString())
        return cut_lineage(df)

    for module in (batch, vectors):
        monkeypatch.setattr(module, "cut_lineage", cut)
    df = spark.createDataFrame([("a", str(i), f"text {i % 2}") for i in range(12)], SCHEMA)
    out, _ = classify_batch(df, stubs.hash_embedding(8), stubs.cluster_label(), stubs.LABEL_TEMPLATE)
    assert out.count() == 12
    assert sum("summary:" in x for x in written) == 1
