"""Deterministic stand-in models, prompts, topics and goals.

Real deployments pass their own model factories; these stubs exist so the
operators can be checked without network access, and each is simple
enough to be restated in SQL for the DuckDB oracle. Factories are
``functools.partial`` objects over the classes below (picklable, built once
per task on the executors)."""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np

# Our own templates, topics and goals (not the reference's).
SUMMARY_TEMPLATE = (
    "Summarise this repository in under five sentences.\n"
    "About: {description}\nREADME: {readme}\nSummary:"
)
SHORT_SUMMARY_TEMPLATE = "In about twenty words, what is this for?\n{description}\n{readme}\nAnswer:"
TOPIC_TEMPLATE = "Pick one topic for the project or name a new one.\nSummary: {summary}\nTopics: {topic_list}\nTopic:"
GOAL_TEMPLATE = (
    "Score the project from 0 to 5 against each goal and answer in JSON.\n"
    "Summary: {summary}\nGoals:\n{goals_formatted}\nJSON:"
)
LABEL_TEMPLATE = "Name this group of projects in three words.\n- {summaries}\nLabel:"

SEED_TOPICS = ["health", "energy", "transport", "education", "tion", "ment"]
GOALS = [
    {"name": "Open Data", "description": "Publishes or improves access to public datasets."},
    {"name": "Public Health", "description": "Helps health services or patients."},
    {"name": "Clean Energy", "description": "Supports renewable energy or lower emissions."},
    {"name": "Digital Skills", "description": "Teaches or trains people in digital work."},
    {"name": "Safer Streets", "description": "Supports policing, safety or emergency services."},
]
PROMPTS = [
    {"prompt_name": "default", "template": SUMMARY_TEMPLATE},
    {"prompt_name": "short", "template": SHORT_SUMMARY_TEMPLATE},
]

TOKEN = re.compile(r"[^ \t\n\r]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text or "")


class FirstWords:
    """Summary stub: the first ``n`` blank-separated words of the prompt, or
    all of them (``None``)."""

    def __init__(self, n: int | None = 20, fail_mod: int | None = None):
        self.n = n
        self.fail_mod = fail_mod

    def __call__(self, prompt: str) -> str:
        if self.fail_mod and len(prompt or "") % self.fail_mod == 0:
            raise RuntimeError("stub model failure")
        return " ".join(tokens(prompt)[: self.n])


class Shout:
    """Echo stub: the prompt in upper case; fails when it contains
    ``fail_on`` (for error-policy checks)."""

    def __init__(self, fail_on: str | None = None):
        self.fail_on = fail_on

    def __call__(self, prompt: str) -> str:
        if self.fail_on and self.fail_on in prompt:
            raise ValueError(f"stub failure on {self.fail_on!r}")
        return prompt.upper()


def _between(text: str, start: str, end: str) -> str:
    i = text.find(start)
    if i < 0:
        return ""
    i += len(start)
    j = text.find(end, i)
    return text[i:] if j < 0 else text[i:j]


class SeedTopic:
    """Topic stub: the first seed topic contained in the summary, else the
    first word of the summary (lower case), else ``misc``. With
    ``use_prompt_list`` it picks from the topic list inside the prompt
    instead, so answers depend on the vocabulary seen so far."""

    def __init__(self, seeds=tuple(SEED_TOPICS), use_prompt_list: bool = False):
        self.seeds = list(seeds)
        self.use_prompt_list = use_prompt_list

    def __call__(self, prompt: str) -> str:
        summary = _between(prompt, "Summary: ", "\nTopics: ")
        if self.use_prompt_list:
            listed = _between(prompt, "\nTopics: ", "\nTopic:")
            candidates = [t for t in listed.split(", ") if t]
        else:
            candidates = self.seeds
        low = summary.lower()
        for t in candidates:
            if t in low:
                return t
        words = tokens(summary)
        return words[0].lower() if words else "misc"


class GoalAnswer:
    """Goal stub: answer text built from the prompt length n. No JSON when
    n % 9 == 0; failure when n % 13 == 0; one goal left out when n % 4 == 0;
    goal i scores (n + i) % 6 with reason ``r<score>``."""

    def __init__(self, goal_names):
        self.goal_names = list(goal_names)

    def __call__(self, prompt: str) -> str:
        n = len(prompt)
        if n % 13 == 0:
            raise RuntimeError("stub goal failure")
        if n % 9 == 0:
            return "Sorry, I cannot evaluate this one."
        obj = {}
        for i, g in enumerate(self.goal_names):
            if n % 4 == 0 and i == n % len(self.goal_names):
                continue
            s = (n + i) % 6
            obj[g] = {"score": s, "reason": f"r{s}"}
        return "Here you go:\n" + json.dumps(obj) + "\nThanks."


class ClusterLabel:
    """Label stub: ``Group <first word of the first bullet>`` padded with
    white space (the caller strips it)."""

    def __call__(self, prompt: str) -> str:
        first = _between(prompt, "\n- ", "\n")
        words = tokens(first)
        return "  Group " + (words[0].lower() if words else "none") + " \n"


class HashEmbedding:
    """Embedding stub: a unit vector seeded by the md5 of the text."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            seed = int(hashlib.md5((t or "").encode("utf-8")).hexdigest()[:8], 16)
            v = np.random.default_rng(seed).standard_normal(self.dim)
            v = v / np.linalg.norm(v)
            out.append(v.astype(np.float32).tolist())
        return out


def first_words(n: int | None = 20, fail_mod: int | None = None):
    return functools.partial(FirstWords, n, fail_mod)


def shout(fail_on: str | None = None):
    return functools.partial(Shout, fail_on)


def seed_topic(seeds=tuple(SEED_TOPICS), use_prompt_list: bool = False):
    return functools.partial(SeedTopic, tuple(seeds), use_prompt_list)


def goal_answer(goal_names):
    return functools.partial(GoalAnswer, tuple(goal_names))


def cluster_label():
    return functools.partial(ClusterLabel)


def hash_embedding(dim: int = 64):
    return functools.partial(HashEmbedding, dim)
