"""JSON extraction from model text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import GOAL_MISSING_REASON
from tessera.functions.text import slug


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_json(c) -> Column:
    """text from the first ``{`` to the last ``}``; none -> null."""
    return F.nullif(F.regexp_extract(_c(c), r"(?s)\{.*\}", 0), F.lit(""))


def number(text: Column) -> Column:
    """A plain or scientific decimal number; anything else (NaN, 4d, 0x1) is null."""
    return F.when(F.trim(text).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.trim(text).try_cast("double"))


def goal_map(json_text) -> Column:
    """Parse once to ``map<string,string>``: one goal value that is not an
    object must not null the other goals (it would with a struct map)."""
    return F.from_json(_c(json_text), "map<string,string>")


def goal_score_columns(answer_map, goals: Sequence[Mapping[str, str] | str]) -> dict[str, Column]:
    """per goal ``<slug>_score DOUBLE`` and ``<slug>_reason STRING``.

    Goal present -> its score (text coerced to a number, junk -> null) and
    reason (missing field -> null; a value that is not an object -> null).
    Goal absent, or nothing parsed -> score 0 and the fixed reason."""
    m = _c(answer_map)
    cols: dict[str, Column] = {}
    for g in goals:
        name = g if isinstance(g, str) else g["name"]
        prefix = name.replace(" ", "_").lower()
        # Repeated keys keep the last value (as a JSON object load does):
        # look the goal up among the map entries and take the last match.
        matches = F.filter(F.map_entries(m), lambda e: e["key"] == F.lit(name))
        present = F.coalesce(F.size(matches) > 0, F.lit(False))
        value = F.element_at(matches, -1)["value"]
        score = number(F.get_json_object(value, "$.score"))
        reason = F.get_json_object(value, "$.reason")
        cols[f"{prefix}_score"] = F.when(present, score).otherwise(F.lit(0.0))
        cols[f"{prefix}_reason"] = F.when(present, reason).otherwise(F.lit(GOAL_MISSING_REASON))
    return cols


def parse_vector(c) -> Column:
    """list text -> vector; malformed, scalar or ``None`` items -> null."""
    return F.from_json(_c(c), "array<double>")


__all__ = ["extract_json", "goal_map", "goal_score_columns", "parse_vector", "slug"]
