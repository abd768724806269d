"""Stand-in inputs derived by Spark from the supplied tables.

The reference reads landed API responses and CSV catalogues; here they are
derived from ``documents``, ``region``/``nation``, ``labels`` and
``embeddings`` so every registered query's work grows with the tables.
Each builder has a DuckDB twin in ``tessera.queries.views``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import first_line

# Fixed values for the stand-ins (not reference values): scan stamp, epoch
# for created_at, URL prefix, README 404 rule, listing page size.
SCAN_STAMP = "2024-06-01 00:00:00"
CREATED_EPOCH = "2020-01-01"
URL_PREFIX = "https://example.org/"
README_404_EVERY = 7
PAGE_ITEMS = 100
REGISTRY_GROUP = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _newlines(c):
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows: account = source, name = 'doc-'||doc_id, description =
    first line, stars = n_chars, forks = line breaks, language = lang,
    readme_snippet = the whole text (the scan cuts it, P3)."""
    d = table(spark, sf_dir, "documents")
    created = F.date_add(F.lit(CREATED_EPOCH).cast("date"), (F.col("doc_id") % 1000).cast("int"))
    created_ts = created.cast("timestamp")
    return d.select(
        F.col("source").alias("account"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
        first_line(F.col("text")).alias("description"),
        F.col("n_chars").alias("stars"),
        _newlines(F.col("text")).cast("bigint").alias("forks"),
        F.col("lang").alias("language"),
        F.concat(F.lit(URL_PREFIX), F.col("source"), F.lit("/doc-"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("readme_snippet"),
        F.lit(SCAN_STAMP).cast("timestamp").alias("last_scanned_utc"),
        created_ts.alias("created_at"),
        F.timestamp_add("DAY", (F.col("n_chars") % 365).cast("int"), created_ts).alias("pushed_at"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry (group, accounts): customers in groups of at most 100, by
    market segment and hundreds of the key; groups grow with the table."""
    c = table(spark, sf_dir, "customer")
    group = F.concat_ws(" ", "c_mktsegment", F.floor(F.col("c_custkey") / REGISTRY_GROUP).cast("string"))
    return c.groupBy(group.alias("group")).agg(F.array_sort(F.collect_list("c_name")).alias("accounts"))


def listing_item_json() -> F.Column:
    """One listing item as raw JSON text, with the field variants the
    scanner must handle: missing vs null vs empty, nameless items."""
    fl = first_line(F.col("text"))
    desc = F.when(F.col("lang") == "de", F.lit(None)).when(F.col("lang") == "fr", F.lit("")).otherwise(fl)
    name = F.when(F.col("n_chars") < 50, F.lit("")).otherwise(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    )
    created = F.date_add(F.lit(CREATED_EPOCH).cast("date"), (F.col("doc_id") % 1000).cast("int"))
    item = F.struct(
        name.alias("name"),
        desc.alias("description"),
        F.when(~F.col("lang").isin("es", "fr"), F.col("n_chars")).alias("stargazers_count"),
        F.when(~F.col("lang").isin("es", "fr"), _newlines(F.col("text"))).alias("forks_count"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("language"),
        F.when(F.col("lang") != "es", F.concat(F.lit(URL_PREFIX), F.col("source"), F.lit("/doc-"), F.col("doc_id").cast("string"))).alias("html_url"),
        F.date_format(created, "yyyy-MM-dd'T'00:00:00").alias("created_at"),
    )
    js = F.to_json(item)  # null fields are left out: "missing"
    # French items carry explicit nulls for the counters: "null" != "missing".
    explicit_null = F.regexp_replace(js, r"\}$", ',"stargazers_count":null,"forks_count":null}')
    return F.when(F.col("lang") == "fr", explicit_null).otherwise(js)


def listing_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed listing responses ``(account, page, body)``: body is the raw
    JSON array of one page (at most 100 items, so each array is bounded).
    One non-object item is added to every page."""
    d = table(spark, sf_dir, "documents")
    page = (F.col("doc_id") / PAGE_ITEMS).cast("bigint")
    items = d.select(
        F.col("source").alias("account"),
        page.alias("page"),
        F.col("doc_id"),
        listing_item_json().alias("item"),
    )
    return items.groupBy("account", "page").agg(
        F.concat(
            F.lit("["),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda s: s["item"]),
                ",",
            ),
            F.lit(',"not-an-object"]'),
        ).alias("body")
    )


def readme_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed README fetches: 200 with the text, or 404 where doc_id % 7 = 0."""
    d = table(spark, sf_dir, "documents")
    missing = (F.col("doc_id") % README_404_EVERY) == 0
    return d.select(
        F.col("source").alias("account"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
        F.when(missing, F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(missing, F.lit(None).cast("string")).otherwise(F.col("text")).alias("body"),
    )


def goal_answer_text(goal_names: list[str], lang_col: str = "lang") -> F.Column:
    """Free-text model answer built from the row's ``quality``, ``toxic``
    and ``lang``: noise + JSON + noise. Labelled rows answer the first two
    goals; the third goal value is not an object for toxic rows; unlabelled
    rows answer nothing parseable."""
    g0, g1, g2 = goal_names[0], goal_names[1], goal_names[2]
    obj = F.concat(
        F.lit('{"' + g0 + '": {"score": '), (F.col("quality") * 5).cast("string"),
        F.lit(', "reason": "quality '), F.col("quality").cast("string"), F.lit('"}, "'),
        F.lit(g1 + '": {"score": "'), (F.col("toxic") + 1).cast("string"), F.lit('"}, "'),
        F.lit(g2 + '": '),
        F.when(F.col("toxic") == 1, F.lit('"n/a"')).otherwise(F.lit('{"score": 2.5, "reason": "half"}')),
        F.lit("}"),
    )
    return F.when(
        F.col("quality").isNull(),
        F.concat(F.lit("I could not evaluate "), F.col(lang_col), F.lit(".")),
    ).otherwise(F.concat(F.lit("Here is the evaluation: "), obj, F.lit(" Hope this helps.")))


def goal_answers(spark: SparkSession, sf_dir: str, goal_names: list[str]) -> DataFrame:
    """Answers per document (see :func:`goal_answer_text`)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.col("source").alias("account"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
        goal_answer_text(goal_names).alias("answer"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")
