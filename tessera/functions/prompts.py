"""Prompt rendering (F1-F3) as column expressions.

The template is split once on the driver into literal pieces and
placeholders; the prompt column is a ``concat`` of literals and columns, so
braces or placeholder names inside the data are never expanded (a chain of
``replace`` calls would re-expand them)."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def template_fields(template: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(template) if f]


def render(template: str, values: Mapping[str, Column | str]) -> Column:
    """Fill ``{name}`` placeholders (``{{``/``}}`` are literal braces) with
    columns; null values render as empty text."""
    parts: list[Column] = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in values:
                raise KeyError(f"template placeholder {{{field}}} has no value")
            v = values[field]
            col = F.col(v) if isinstance(v, str) else v
            parts.append(F.coalesce(col.cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def around(template: str, field: str, values: Mapping[str, str]) -> list[str]:
    """The texts before, between and after the placeholders ``{field}``, the
    others filled with ``values``: ``text.join`` of them is the prompt of a text."""
    texts = [""]
    for literal, name, _spec, _conv in string.Formatter().parse(template):
        texts[-1] += literal
        if name == field:
            texts.append("")
        elif name is not None:
            if name not in values:
                raise KeyError(f"template placeholder {{{name}}} has no value")
            texts[-1] += values[name]
    return texts


def render_prompt(template: str, description="description", readme="readme") -> Column:
    """summary prompt from description and README."""
    return render(template, {"description": description, "readme": readme})


def topic_list_text(topics: Sequence[str]) -> str:
    """F2 helper: topics joined by comma and blank."""
    return ", ".join(topics)


def render_topic_prompt(template: str, summary="summary", topics: Sequence[str] | Column = ()) -> Column:
    """topic prompt; ``topics`` is a literal list or an array column
    (the vocabulary of the current wave)."""
    if isinstance(topics, Column):
        topic_col = F.array_join(topics, ", ")
    else:
        topic_col = F.lit(topic_list_text(list(topics)))
    return render(template, {"summary": summary, "topic_list": topic_col})


def goals_text(goals: Sequence[Mapping[str, str]]) -> str:
    """F3 helper: one bullet ``- name: description`` per goal."""
    return "\n".join(f"- {g['name']}: {g['description']}" for g in goals)


def render_goal_prompt(template: str, goals: Sequence[Mapping[str, str]], summary="summary") -> Column:
    """goal prompt with the bullet list of goals."""
    return render(template, {"summary": summary, "goals_formatted": F.lit(goals_text(goals))})
