"""Sources, catalogue projection and joins on hand-made rows."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import joins as J
from tessera.operators.filters import drop_missing_readme, normalise_columns, pending
from tessera.schemas import CATALOGUE, NO_DESCRIPTION, NO_LANGUAGE, README_MISSING, SUMMARY_ERROR
from tessera.sources import catalogue as S
from tessera.sources import csvsplit, ingest


def responses(spark, rows):
    return spark.createDataFrame([(a, 0, json.dumps(items)) for a, items in rows], "account string, page bigint, body string")


def test_to_catalogue_missing_null_empty(spark):
    items = [
        {"name": "full", "description": "d", "stargazers_count": 5, "forks_count": 2, "language": "Go", "html_url": "u"},
        {"name": "missing"},
        {"name": "nulls", "description": None, "stargazers_count": None, "forks_count": None, "language": None, "html_url": None},
        {"name": "empty", "description": "", "language": ""},
        {"name": ""},
        {"description": "nameless"},
        "not an object",
        7,
    ]
    rows = ingest.to_catalogue(ingest.explode_listing(responses(spark, [("acc", items)])), F.lit(None).cast("timestamp"))
    got = {r["name"]: r for r in rows.collect()}
    assert set(got) == {"full", "missing", "nulls", "empty"}
    assert (got["full"]["stars"], got["full"]["url"], got["full"]["language"]) == (5, "u", "Go")
    assert (got["missing"]["stars"], got["missing"]["forks"], got["missing"]["url"]) == (0, 0, "")
    assert (got["nulls"]["stars"], got["nulls"]["forks"], got["nulls"]["url"]) == (None, None, None)
    for k in ("missing", "nulls", "empty"):
        assert got[k]["description"] == NO_DESCRIPTION and got[k]["language"] == NO_LANGUAGE
        assert got[k]["readme_snippet"] == README_MISSING


def test_cap_per_account(spark):
    items = [{"name": f"r{i}"} for i in range(7)]
    ex = ingest.explode_listing(responses(spark, [("a", items), ("b", items[:2])]))
    capped = ingest.cap_per_account(ex, 3)
    assert sorted((r["account"], r["pos"]) for r in capped.collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1)]
    assert ingest.cap_per_account(ex, None).count() == 9


def test_page_cap_counts_non_objects(spark):
    items = [{"name": "a"}, "junk", {"name": "b"}, 5, {"name": "c"}]
    ex = ingest.explode_listing(responses(spark, [("acc", items)]), objects_only=False)
    kept = ingest.only_objects(ingest.cap_per_account(ex, 3))
    assert sorted(r["pos"] for r in kept.collect()) == [0, 2]


def test_registry_flatten_and_allow(spark, tmp_path):
    path = str(tmp_path / "reg.json")
    with open(path, "w") as f:
        json.dump({"UK": ["a", "b", "a"], "FR": "not a list", "DE": ["c"]}, f)
    reg = ingest.read_registry(spark, path)
    assert sorted(r["account"] for r in ingest.account_names(reg).collect()) == ["a", "b", "c"]
    assert sorted(r["account"] for r in ingest.account_names(reg, []).collect()) == ["a", "b", "c"]
    assert [r["account"] for r in ingest.account_names(reg, ["b", "z"]).collect()] == ["b"]


def test_new_items_first_wins_and_empty_keys_ignored(spark):
    listing = spark.createDataFrame(
        [("a", "x", 0, 1, "first"), ("a", "x", 1, 0, "second"), ("a", "y", 0, 0, "y"), ("a", "z", 0, 2, "z")],
        "account string, name string, page bigint, pos int, tag string",
    )
    stored = spark.createDataFrame([("a", "y"), ("a", ""), (None, "z")], "account string, name string")
    out = {r["name"]: r["tag"] for r in J.new_items(listing, stored).collect()}
    assert out == {"x": "first", "z": "z"}


def test_filter_keeps_all_keys_that_are_asked_for(spark):
    have = spark.range(5000).select(F.concat(F.lit("a"), F.col("id") % 7).alias("account"), F.col("id").cast("string").alias("name"))
    asked = have.filter("cast(name as int) % 50 = 0")
    kept = J.maybe_among(have, asked, ["account", "name"])
    assert asked.join(kept, ["account", "name"], "left_anti").isEmpty() and kept.count() < 120
    assert J.maybe_among(have, asked.limit(0), ["account", "name"]).count() == 0


def test_attach_readme_failure_paths(spark):
    cat = spark.createDataFrame([("a", n) for n in ["ok", "404", "500", "nobody", "empty", "absent"]], "account string, name string")
    readmes = spark.createDataFrame(
        [("a", "ok", 200, "x" * 900), ("a", "404", 404, None), ("a", "500", 500, "err"), ("a", "nobody", 200, None),
         ("a", "empty", 200, "")],
        "account string, name string, status int, body string",
    )
    got = {r["name"]: r["readme_snippet"] for r in J.attach_readme(cat, readmes).collect()}
    assert got["ok"] == "x" * 800 and got["empty"] == ""
    assert all(got[k] == README_MISSING for k in ["404", "500", "nobody", "absent"])


def test_csv_round_trip_multiline_quotes_and_na(spark, tmp_path):
    rows = [("a", "r1", 'say "hi"\nnext line', 3, None, "NA", "u", "readme, with comma", None, None, None)]
    df = spark.createDataFrame(rows, CATALOGUE)
    path = str(tmp_path / "cat_csv")
    S.write_catalogue_csv(df, path)
    back = S.read_catalogue_csv(spark, path).first()
    assert back["description"] == 'say "hi"\nnext line'
    assert back["language"] == "NA" and back["forks"] is None and back["readme_snippet"] == "readme, with comma"


def test_csv_records_over_range_borders(spark, tmp_path):
    """Many ranges of a few bytes; cells with line breaks, doubled quotes and
    line ends of two characters lie over their borders. Same rows as Spark's own
    reader of whole files."""
    rng = random.Random(4)
    cell = lambda: "".join(rng.choice(['a', 'b,', '"', "\n", "\r\n", " ", "é", "NA"]) for _ in range(rng.randrange(12)))
    quoted = lambda c: '"' + c.replace('"', '""') + '"' if c else rng.choice(["", '""'])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "xyz"])
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        lines = ['x,y,"z', 'more"'] + [",".join(quoted(cell()) for _ in range(3)) for _ in range(25)]
        lines[5:5] = ["", '"' + "long\n" * 30 + '",b,c']
        (tmp_path / f"f{k}.csv").write_bytes(((end if k == 1 else "") + end.join(lines) + (end if k != 2 else "")).encode())
    whole = spark.read.options(**S.CSV_OPTIONS).schema(schema).csv(str(tmp_path))
    wanted = sorted(map(str, whole.collect()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("90b", "1000b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert sorted(map(str, S.read_catalogue_csv(spark, str(tmp_path), schema).collect())) == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_csv_file_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "one")
    text = F.concat(F.lit('line "one"\n'), F.repeat(F.lit("abcdefg "), 100), F.col("id").cast("string"))
    df = spark.range(20_000).select(F.col("id").cast("string").alias("name"), text.alias("text"))
    df.coalesce(1).write.options(**S.CSV_OPTIONS).csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        tasks = csvsplit._lines(spark, path).select(F.spark_partition_id()).distinct().count()
        back = S.read_catalogue_csv(spark, path, df.schema)
        assert tasks >= 15 and back.count() == 20_000 and back.exceptAll(df).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_overwrite_and_verify(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", README_MISSING), ("a", "2", "ok"), ("a", "3", None)],
                               "account string, name string, readme_snippet string")
    path = str(tmp_path / "cat")
    df.write.parquet(path)
    reject = F.col("readme_snippet").eqNullSafe(F.lit(README_MISSING))
    res = S.overwrite_and_verify(spark, path, ~reject, reject)
    assert res == {"before": 3, "kept": 2, "after": 2, "remaining_rejected": 0, "rewritten": 1}
    assert drop_missing_readme(df).count() == 2  # nulls are kept


def test_normalise_and_pending(spark):
    df = spark.createDataFrame([("a", "1", "r", None), ("a", "2", "r", SUMMARY_ERROR), ("a", "3", "r", "s")],
                               "account string, name string, readme_snippet string, summary string")
    n = normalise_columns(df)
    assert "readme" in n.columns and "readme_snippet" not in n.columns and "description" in n.columns
    assert [r["name"] for r in pending(n).collect()] == ["1"]
    assert sorted(r["name"] for r in pending(n, retry_errors=True).collect()) == ["1", "2"]
    both = df.withColumn("readme", F.lit("keep"))
    assert normalise_columns(both).first()["readme"] == "keep"
