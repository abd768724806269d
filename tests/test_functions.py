"""Scalar functions on hand-made edge rows (FIXTURES part 1)."""

from tessera.functions import jsonx, prompts
from tessera.functions import text as tx
from tessera.schemas import GOAL_MISSING_REASON


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"c {dtype}").select(col.alias("out")).first()["out"]


def test_render_does_not_expand_placeholders_in_data(spark):
    df = spark.createDataFrame([("use {readme} here", "body {description}"), (None, "x")], "description string, readme string")
    out = [r["p"] for r in df.select(prompts.render_prompt("D={description};R={readme};{{lit}}").alias("p")).collect()]
    assert out == ["D=use {readme} here;R=body {description};{lit}", "D=;R=x;{lit}"]


def test_topic_and_goal_prompts():
    assert prompts.topic_list_text(["a", "b c"]) == "a, b c"
    assert prompts.goals_text([{"name": "G", "description": "d"}, {"name": "H", "description": "e"}]) == "- G: d\n- H: e"


def test_extract_json(spark):
    assert one(spark, jsonx.extract_json("c"), 'noise {"a": {"b": 1}} tail } end') == '{"a": {"b": 1}} tail }'
    assert one(spark, jsonx.extract_json("c"), "no json here") is None
    assert one(spark, jsonx.extract_json("c"), "x\n{\n}\ny") == "{\n}"


GOALS = ["Open Data", "Public Health", "Clean Energy"]


def parse(spark, text):
    cols = jsonx.goal_score_columns(jsonx.goal_map(jsonx.extract_json("c")), GOALS)
    df = spark.createDataFrame([(text,)], "c string")
    return df.select(*[c.alias(k) for k, c in cols.items()]).first().asDict()


def test_goal_scores_edge_cases(spark):
    r = parse(spark, 'Sure: {"Open Data": {"score": "4", "reason": "ok"}, "Public Health": "n/a", '
                     '"Clean Energy": {"score": 2.5}} thanks')
    assert r["open_data_score"] == 4.0 and r["open_data_reason"] == "ok"
    assert r["public_health_score"] is None and r["public_health_reason"] is None  # not an object
    assert r["clean_energy_score"] == 2.5 and r["clean_energy_reason"] is None  # missing field
    r = parse(spark, '{"Open Data": {"score": "junk", "reason": "x"}}')
    assert r["open_data_score"] is None
    assert r["public_health_score"] == 0.0 and r["public_health_reason"] == GOAL_MISSING_REASON
    r = parse(spark, "no json at all")
    assert all(r[f"{s}_score"] == 0.0 for s in ["open_data", "public_health", "clean_energy"])
    r = parse(spark, '{"Open Data": {"score": 1}, "Open Data": {"score": 3}}')
    assert r["open_data_score"] == 3.0  # repeated keys: last wins


def test_parse_vector(spark):
    assert one(spark, jsonx.parse_vector("c"), "[0.5, 1, -2.0]") == [0.5, 1.0, -2.0]
    for bad in ["[0.1, None]", "3.5", "not a list", None]:
        assert one(spark, jsonx.parse_vector("c"), bad) is None


def test_clean_text(spark):
    got = one(spark, tx.clean_text("c"), "The Café_Über-data, at 2 o'clock: naïve   résumé!\nok")
    assert got == "café_über data clock naïve résumé"
    assert one(spark, tx.clean_text("c", []), "an ox the cat") == "the cat"


def test_strip_label_and_title(spark):
    assert one(spark, tx.strip_label("c"), "  \n Data Tools \t\n") == "Data Tools"
    assert one(spark, tx.title_from_slug(tx.slug("c")), "Energy Security and Net Zero") == "Energy Security And Net Zero"
    assert one(spark, tx.slug("c"), "Open Data") == "open_data"


def test_truncate_counts_code_points(spark):
    text = "a" * 799 + "😀" + "tail"
    assert one(spark, tx.truncate_readme("c"), text) == "a" * 799 + "😀"


def test_repo_key_and_vector_text(spark):
    df = spark.createDataFrame([("acc", "repo", [1.0, 2.5])], "account string, name string, v array<double>")
    r = df.select(tx.repo_key().alias("k"), tx.vector_to_text("v").alias("t")).first()
    assert r["k"] == "acc/repo" and r["t"] == "[1.0,2.5]"
