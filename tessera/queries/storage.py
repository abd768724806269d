"""Queries for catalogue storage and stage jobs (S4, S5, S7, P4, T1, E3):
each writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import stubs
from tessera.operators.topk import sort_desc
from tessera.plans.summarise import summarise_job
from tessera.queries.models import PROMPT_SQL
from tessera.queries.registry import query, ts, ts_sql
from tessera.queries.views import CATALOGUE_SQL, SUMMARISED_SQL, all_words_sql, summarised, with_
from tessera.schemas import CATALOGUE
from tessera.session import shared_path
from tessera.sources import standins
from tessera.sources.catalogue import append_catalogue, read_catalogue_csv, write_catalogue_csv, write_stage
from tessera.sources.ingest import stamp_scan_time

KEY = ["account", "name"]
TS = ["last_scanned_utc", "created_at", "pushed_at"]
CAT_SQL = f"""SELECT account, name, description, stars, forks, language, url, readme_snippet,
  {ts_sql('last_scanned_utc')} AS last_scanned_utc, {ts_sql('created_at')} AS created_at, {ts_sql('pushed_at')} AS pushed_at
FROM catalogue"""


def _ts_out(df):
    return df.withColumns({c: ts(c) for c in TS})


@query("read_catalogue_csv", with_(CATALOGUE_SQL, CAT_SQL))
def q_read_catalogue_csv(spark, sf_dir):
    """Export the catalogue as CSV (multi-line quoted cells) and read it
    back with the fixed schema."""
    path = shared_path(spark, "catalogue-csv")
    write_catalogue_csv(standins.catalogue(spark, sf_dir), path)
    return _ts_out(read_catalogue_csv(spark, path, CATALOGUE))


@query("append_catalogue", with_(CATALOGUE_SQL, CAT_SQL + "\nUNION ALL\n" + CAT_SQL.replace("readme_snippet,", "CAST(NULL AS VARCHAR) AS readme_snippet,", 1)))
def q_append_catalogue(spark, sf_dir):
    """Two appends to one Parquet catalogue; the second batch lacks
    ``readme_snippet``, which becomes null in the fixed column order."""
    path = shared_path(spark, "catalogue-append")
    cat = standins.catalogue(spark, sf_dir)
    append_catalogue(cat, path)
    append_catalogue(cat.drop("readme_snippet"), path)
    return _ts_out(spark.read.parquet(path))


@query("write_stage", with_(CATALOGUE_SQL, CAT_SQL))
def q_write_stage(spark, sf_dir):
    """A stage written twice for one run (the rewrite replaces it) next
    to another run's partition; read back the first run only."""
    path = shared_path(spark, "stages")
    cat = standins.catalogue(spark, sf_dir)
    write_stage(cat.limit(0), path, "run-a", "catalogue")
    write_stage(cat, path, "run-b", "catalogue")
    write_stage(cat, path, "run-a", "catalogue")
    return _ts_out(spark.read.parquet(path).filter(F.col("run_id") == "run-a").drop("run_id", "stage"))


@query("stamp_scan_time", "SELECT language, count(*) AS n, count(*) AS stamped, 1 AS times FROM (SELECT lang AS language FROM documents) GROUP BY language")
def q_stamp_scan_time(spark, sf_dir):
    """One scan time per job (non-deterministic: rows-only check)."""
    stamped = stamp_scan_time(standins.catalogue(spark, sf_dir))
    now = F.abs(F.unix_timestamp("last_scanned_utc") - F.unix_timestamp(F.current_timestamp())) < 86400
    return stamped.groupBy("language").agg(F.count("*").alias("n"), F.count_if(now).alias("stamped"),
                                           F.count_distinct("last_scanned_utc").cast("int").alias("times"))


@query("sort_desc", with_(CATALOGUE_SQL, "SELECT account, name, stars FROM catalogue"))
def q_sort_desc(spark, sf_dir):
    """Descending sort with nulls last (the row set is the table)."""
    return sort_desc(standins.catalogue(spark, sf_dir), "stars").select(*KEY, "stars")


@query(
    "summarise_job",
    with_(SUMMARISED_SQL, f"SELECT account, name, coalesce(summary, {all_words_sql(PROMPT_SQL)}) AS summary FROM summarised"),
)
def q_summarise_job(spark, sf_dir):
    """E3 = E2 -> M4 -> S7, read back from the run's partition."""
    path = shared_path(spark, "summarised")
    summarise_job(summarised(spark, sf_dir), path, "run-1", stubs.SUMMARY_TEMPLATE, stubs.first_words(None))
    return spark.read.parquet(path).filter(F.col("run_id") == "run-1").select(*KEY, "summary")
