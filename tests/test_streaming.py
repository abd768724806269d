"""Resume behaviour of the streaming jobs: interrupt, rerun, compare."""

import json

from tessera.streaming.jobs import stream_catalogue, stream_enrich
from tessera import stubs
from tessera.plans.summarise import summarise


def land(spark, path, items, account="acc"):
    spark.createDataFrame([(account, 0, json.dumps(items))], "account string, page bigint, body string") \
        .write.mode("append").json(path)


def test_catalogue_stream_resumes_one_row_per_key(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    stored = spark.createDataFrame([("acc", "known")], "account string, name string")
    land(spark, landing, [{"name": "a"}, {"name": "b"}, {"name": "known"}])
    stream_catalogue(spark, landing, out, ckpt, stored)
    land(spark, landing, [{"name": "b"}, {"name": "c"}, {"name": ""}])  # next run, overlapping keys
    stream_catalogue(spark, landing, out, ckpt, stored)
    names = sorted(r["name"] for r in spark.read.parquet(out).collect())
    assert names == ["a", "b", "c"]


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    """The driver dies after a batch's output and before its commit: the batch
    is run again, over the state that it started from."""
    landing, out, ckpt = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    land(spark, landing, [{"name": "a"}, {"name": "b"}])
    stream_catalogue(spark, landing, out, ckpt)
    land(spark, landing, [{"name": "c"}, {"name": "a"}, {"name": "c", "description": "later"}])
    stream_catalogue(spark, landing, out, ckpt)
    first = sorted(map(str, spark.read.parquet(out).drop("last_scanned_utc").collect()))
    last = max(int(p.name) for p in (tmp_path / "ckpt" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "ckpt" / "commits").iterdir():
        if p.name in (str(last), f".{last}.crc"):
            p.unlink()
    stream_catalogue(spark, landing, out, ckpt)
    assert sorted(map(str, spark.read.parquet(out).drop("last_scanned_utc").collect())) == first
    assert sorted(r["name"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_new_keys_are_found_without_python_and_stored_ones_in_the_first_run(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    stored = spark.createDataFrame([("acc", "known"), ("acc", "known"), ("acc", ""), (None, "x")], "account string, name string")
    rows = [("acc", 2, [{"name": "a", "description": "page 2"}]), ("acc", 1, [{"name": "b"}, {"name": "a", "description": "page 1"}]),
            ("acc", None, [{"name": "b", "description": "no page"}, {"name": "known"}]), (None, 1, [{"name": "x"}])]
    spark.createDataFrame([(a, p, json.dumps(i)) for a, p, i in rows], "account string, page bigint, body string").write.json(landing)
    query = stream_catalogue(spark, landing, out, ckpt, stored)
    plan = query._jsq.explainInternal(False)
    assert "StateStoreSave" in plan and "Python" not in plan and "Pandas" not in plan
    got = {(r["account"], r["name"]): r["description"] for r in spark.read.parquet(out).collect()}
    assert got == {("acc", "a"): "page 1", ("acc", "b"): "no page", (None, "x"): "No description"}
    land(spark, landing, [{"name": "a"}, {"name": "late"}, {"name": "known"}])
    stream_catalogue(spark, landing, out, ckpt, spark.createDataFrame([("acc", "late")], stored.schema))
    assert sorted(r["name"] for r in spark.read.parquet(out).collect()) == ["a", "b", "late", "x"]


def test_enrich_stream_saves_each_batch(spark, tmp_path):
    src = spark.createDataFrame([("a", str(i), f"d{i}", "r", None) for i in range(12)],
                                "account string, name string, description string, readme string, summary string")
    landing = str(tmp_path / "land")
    src.repartition(4).write.parquet(landing)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    stream_enrich(spark, landing, src.schema, lambda b: summarise(b, stubs.SUMMARY_TEMPLATE, stubs.first_words(3)),
                  out, ckpt, max_files=1)
    res = spark.read.parquet(out)
    assert res.count() == 12 and res.select("batch_id").distinct().count() >= 2
    assert all(r["summary"].startswith("Summarise this repository") for r in res.collect())
