"""The scan job (E1): registry -> accounts -> listings -> new catalogue rows
with READMEs, appended to the catalogue. Network fetches are out of scope:
the job starts from landed registry, listing and README responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import attach_readme, new_items
from tessera.session import cut_lineage
from tessera.sources.catalogue import append_catalogue, read_table, table_exists
from tessera.sources.ingest import (
    account_names,
    cap_per_account,
    explode_listing,
    only_objects,
    project_catalogue,
    to_catalogue,
)


def scan(registry: DataFrame, responses: DataFrame, readmes: DataFrame, catalogue: DataFrame | None,
         allow: Sequence[str] | DataFrame | None = None, page: int | None = None,
         scan_time: Column | None = None) -> DataFrame:
    """E1 = S1 P1 J2 S2 S3 P2 (P4) J1 J3 (P3); returns the rows to append."""
    accounts = account_names(registry, allow)
    listed = responses.join(accounts, "account", "left_semi")
    items = only_objects(cap_per_account(explode_listing(listed, objects_only=False), page))
    rows = to_catalogue(items, scan_time)
    if catalogue is not None:
        rows = new_items(rows, catalogue, order=("page", "pos"))
    else:
        from tessera.operators.joins import first_per_key

        rows = first_per_key(rows, ["account", "name"], ["page", "pos"])
    rows = attach_readme(rows, readmes)
    return project_catalogue(rows)


def scan_job(registry: DataFrame, responses: DataFrame, readmes: DataFrame, catalogue_path: str,
             allow=None, page: int | None = None) -> int:
    """E1 with its sink (S5): read the stored catalogue if its path holds
    anything (a table that can't be read fails the job), append the new rows,
    return how many were appended."""
    spark = registry.sparkSession
    stored = read_table(spark, catalogue_path) if table_exists(spark, catalogue_path) else None
    rows = cut_lineage(scan(registry, responses, readmes, stored, allow, page, scan_time=F.current_timestamp()))
    append_catalogue(rows, catalogue_path)
    return rows.count()
