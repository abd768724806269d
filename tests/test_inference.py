"""Batch inference operators with stub models."""

import pytest
from pyspark.sql import functions as F

from tessera import stubs
from tessera.functions.prompts import render_prompt, render_topic_prompt
from tessera.operators import inference
from tessera.operators.inference import embed, predict_text
from tessera.plans.classify import classify_goals, classify_open_vocab
from tessera.plans.summarise import summarise
from tessera.schemas import GOAL_MISSING_REASON, SUMMARY_ERROR


def rows(spark):
    return spark.createDataFrame(
        [("a", "1", "fine", "r", None), ("a", "2", "boom", "r", None), ("a", "3", "done", "r", "kept"),
         ("a", "4", "err", "r", SUMMARY_ERROR)],
        "account string, name string, description string, readme string, summary string",
    )


def test_summarise_sentinel_and_resume(spark):
    out = {r["name"]: r["summary"] for r in summarise(rows(spark), "{description}|{readme}", stubs.shout("boom")).collect()}
    assert out == {"1": "FINE|R", "2": SUMMARY_ERROR, "3": "kept", "4": SUMMARY_ERROR}
    retried = summarise(rows(spark), "{description}|{readme}", stubs.shout("boom"), retry_errors=True)
    assert {r["name"]: r["summary"] for r in retried.collect()}["4"] == "ERR|R"


def test_raise_policy_fails_job(spark):
    df = rows(spark)
    with pytest.raises(Exception):
        predict_text(df, render_prompt("{description}"), stubs.shout("boom"), on_error="raise").collect()


def test_answers_leave_in_pieces(spark):
    """One batch of 8 MB of texts with nulls and faults gives many small ones."""
    texts = [None if i % 11 == 5 else f"t{i} " + "x" * (i * 37 % 4000) + ("boom" if i % 7 == 3 else "") for i in range(4000)]
    run = inference.text_model_udf(stubs.shout("boom")).func
    pieces = list(run(iter([inference.pa.array(texts)])))
    assert max(map(len, pieces)) <= inference.PIECE_ROWS and max(p.nbytes for p in pieces) < 2 * inference.PIECE_CHARS
    assert [r["value"] for p in pieces for r in p.to_pylist()] == [t and (SUMMARY_ERROR if "boom" in t else t.upper()) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, description string").coalesce(1)
    got = predict_text(df, F.col("description"), stubs.shout("boom"), error_col="error").collect()
    assert {r["id"]: r["summary"] for r in got} == {i: t and (SUMMARY_ERROR if "boom" in t else t.upper()) for i, t in enumerate(texts)}
    assert all((r["error"] is not None) == ("boom" in (texts[r["id"]] or "")) for r in got)


def test_embed_batches(spark):
    df = spark.createDataFrame([(f"text {i}",) for i in range(23)], "summary string")
    out = embed(df, stubs.hash_embedding(8), batch_size=10).collect()
    assert len(out) == 23 and all(len(r["embedding"]) == 8 for r in out)
    again = embed(df, stubs.hash_embedding(8), batch_size=3).collect()
    assert sorted(map(tuple, (r["embedding"] for r in out))) == sorted(map(tuple, (r["embedding"] for r in again)))


def topic_list(vocab):
    return [r["topic"] for r in vocab.orderBy("rank").collect()]


def test_open_vocab_wave_of_one_equals_sequential(spark):
    words = ["alpha beta", "beta gamma", "gamma alpha", "delta", "alpha", "epsilon delta", "zeta", "beta"]
    data = [("a", f"r{i}", w, f"2024-01-{20 - i:02d}") for i, w in enumerate(words)]
    df = spark.createDataFrame(data, "account string, name string, summary string, created_at string").withColumn(
        "created_at", F.col("created_at").cast("timestamp"))
    out, vocab = classify_open_vocab(df, stubs.TOPIC_TEMPLATE, stubs.seed_topic(("gamma",), use_prompt_list=True),
                                     ["gamma"], waves=[1] * len(words))
    got = {r["name"]: r["topic"] for r in out.collect()}
    # By hand: the first known topic in the text, else its first word, which is known from then on.
    assert [got[f"r{i}"] for i in range(len(words))] == ["alpha", "gamma", "gamma", "delta", "alpha", "delta", "zeta", "beta"]
    assert topic_list(vocab) == ["gamma", "alpha", "delta", "zeta", "beta"]
    # Larger waves: same first-appearance order of the vocabulary for an
    # answer that does not depend on it.
    out2, vocab2 = classify_open_vocab(df, stubs.TOPIC_TEMPLATE, stubs.seed_topic(("gamma",)), ["gamma"], waves=[3])
    vocab2 = topic_list(vocab2)
    assert vocab2[0] == "gamma" and len(set(vocab2)) == len(vocab2)


def test_classify_goals_guards(spark):
    df = spark.createDataFrame([("a", "1", "a useful tool"), ("a", "2", None), ("a", "3", SUMMARY_ERROR)],
                               "account string, name string, summary string")
    goals = stubs.GOALS[:2]
    out = {r["name"]: r for r in classify_goals(df, stubs.GOAL_TEMPLATE, goals,
                                                  stubs.goal_answer([g["name"] for g in goals])).collect()}
    assert out["2"]["open_data_score"] is None and out["3"]["public_health_reason"] is None
    r = out["1"]
    assert r["open_data_score"] is not None and (r["open_data_reason"] or GOAL_MISSING_REASON)


def many_topics(spark):
    """Three rows, the first a wave of its own, and 10,050 topics known before."""
    seeds = [f"t{i:05d}x" for i in range(10_050)]
    data = [("a", "r0", "newest words"), ("a", "r1", "about t10049x"), ("a", "r2", "the newest of all")]
    df = spark.createDataFrame(data, "account string, name string, summary string")
    return classify_open_vocab(df, stubs.TOPIC_TEMPLATE, stubs.seed_topic((), use_prompt_list=True), seeds, waves=[1]), seeds


def test_open_vocab_lists_every_topic(spark):
    (out, _), _ = many_topics(spark)
    assert {r["name"]: r["topic"] for r in out.collect()} == {"r0": "newest", "r1": "t10049x", "r2": "newest"}


def test_open_vocab_topics_adds_none_that_is_known(spark):
    (_, vocab), seeds = many_topics(spark)
    assert topic_list(vocab) == [*seeds, "newest"]


def test_around_is_what_render_gives(spark):
    from tessera.functions.prompts import around

    template = "{{x}} {summary}, {topic_list}; {summary}"
    rows = spark.createDataFrame([("a {b}",), ("",)], "summary string")
    for r in rows.select("summary", render_topic_prompt(template, "summary", ["one", "{two}"]).alias("p")).collect():
        assert r["summary"].join(around(template, "summary", {"topic_list": "one, {two}"})) == r["p"]
