"""All registered queries: Spark callables and their DuckDB oracles."""

from tessera.queries import models, relational, storage, streamq, textq, vectorq  # noqa: F401  (registers queries)
from tessera.queries.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
