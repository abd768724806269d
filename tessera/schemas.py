"""Fixed schemas per stage and the text sentinels carried in outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Sentinel texts that must equal the reference's outputs.
NO_DESCRIPTION = "No description"
NO_LANGUAGE = "None specified"
README_MISSING = "README not available"
SUMMARY_ERROR = "Error generating summary."
UNCATEGORIZED = "Uncategorized"
GOAL_MISSING_REASON = "Evaluation missing from LLM output."
# README truncation, listing page size, save interval,
# embedding batch, neighbours, reduced dims, minimum cluster size.
README_CHARS = 800
LISTING_PAGE = 100
SAVE_EVERY = 40
EMBED_BATCH = 10
KNN_K = 15
REDUCED_DIMS = 10
MIN_CLUSTER_SIZE = 5
LABEL_SAMPLE = 5
CATALOGUE_COLUMNS = [
    "account", "name", "description", "stars", "forks", "language", "url", "readme_snippet",
    "last_scanned_utc", "created_at", "pushed_at",
]
# ---------------------------------------------------------------------------

KEY = ["account", "name"]

LONGS, TIMES = ("stars", "forks"), ("last_scanned_utc", "created_at", "pushed_at")
CATALOGUE = T.StructType(
    [T.StructField(c, T.LongType() if c in LONGS else T.TimestampType() if c in TIMES else T.StringType()) for c in CATALOGUE_COLUMNS]
)

REGISTRY = T.StructType(
    [T.StructField("group", T.StringType()), T.StructField("accounts", T.ArrayType(T.StringType()))]
)

# One listing item as landed JSON. Everything is read as text first so that
# "missing" and "null" can be told apart through the raw map (see P2).
LISTING_ITEM = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("forks_count", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("html_url", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("pushed_at", T.StringType()),
    ]
)

README_RESPONSE = T.StructType(
    [
        T.StructField("account", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

GOALS = T.StructType([T.StructField("name", T.StringType()), T.StructField("description", T.StringType())])
TOPICS = T.StructType([T.StructField("topic", T.StringType()), T.StructField("rank", T.IntegerType())])
PROMPTS = T.StructType([T.StructField("prompt_name", T.StringType()), T.StructField("template", T.StringType())])


def summarised_schema() -> T.StructType:
    fields = [f for f in CATALOGUE.fields if f.name != "readme_snippet"]
    pos = [f.name for f in fields].index("url") + 1
    fields.insert(pos, T.StructField("readme", T.StringType()))
    return T.StructType(fields + [T.StructField("summary", T.StringType())])
