"""Physical-plan checks: no cartesian products, partial top-k before the
shuffle, pruned scans."""

import pytest

import __spark_entry__ as entry

RELATIONAL = [
    "flatten_registry", "cap_per_account", "to_catalogue", "attach_readme", "new_items", "pending",
    "pending_embeddings", "drop_missing_readme", "fill_text", "to_score", "nonempty_text", "assign_topic",
    "map_labels", "attach_clusters", "cross_prompts", "cross_goals", "value_counts", "null_profile",
    "describe_numeric", "unique_vs_total", "score_histogram", "total_score", "cluster_prompt_text",
    "top_per_goal", "duplicate_rows", "sample_per_cluster", "random_per_group", "topics_per_cluster",
    "examples_per_cluster", "limit_top", "top_values", "high_impact", "sample_rows", "merge_results",
    "parse_goal_scores", "classify_goals", "summarise", "scan",
]


def plan(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cartesian_products(spark, sf_dir, name):
    p = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["top_per_goal", "sample_per_cluster", "cap_per_account", "examples_per_cluster"])
def test_partial_top_k_before_shuffle(spark, sf_dir, name):
    p = plan(spark, sf_dir, name)
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["limit_top", "top_values", "high_impact", "sample_rows"])
def test_global_top_k_is_take_ordered(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, name)


def test_scan_reads_only_needed_columns(spark, sf_dir):
    p = plan(spark, sf_dir, "value_counts")
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "documents" in line]
    assert scans and all("ReadSchema: struct<lang:string>" in s for s in scans)


def test_pending_filter_runs_before_the_model(spark, sf_dir):
    p = plan(spark, sf_dir, "summarise")
    # The model (ArrowEvalPython) sits above the null-summary filter.
    model_at = p.index("ArrowEvalPython")
    assert "isnull" in p[model_at:].lower() or "IsNull" in p[model_at:]
