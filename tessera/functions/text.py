"""String functions (F4, F8-F11, P3), all JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schemas import README_CHARS

# ---------------------------------------------------------------------------
# The default English stop-word list used when cleaning text
# for clustering (the public NLTK English list; callers may pass their own).
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't "
    "didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't "
    "ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()
# A non-word character: anything but a letter, a digit or the underscore.
NON_WORD = r"[^\p{L}\p{N}_]"
# Minimum kept word length is three code points.
MIN_WORD_CHARS = 3
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_readme(c, n: int = README_CHARS) -> Column:
    """First ``n`` code points."""
    return F.substring(_c(c), 1, n)


def slug(c) -> Column:
    """blanks to underscores, lower case."""
    return F.lower(F.replace(_c(c), F.lit(" "), F.lit("_")))


def word_runs(c) -> Column:
    """All words of F8, before any is dropped: lower, non-word -> blank, split
    on blank runs (a text without words: one empty word)."""
    spaced = F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), NON_WORD, " ")
    return F.split(F.trim(spaced), " +")


def clean_tokens(c, stop_words: Iterable[str] | None = None) -> Column:
    """F8 as an array of kept words: those of ``word_runs`` but stop words and
    words shorter than three characters."""
    stops = list(ENGLISH_STOP_WORDS if stop_words is None else stop_words)
    words = word_runs(c)
    return F.filter(words, lambda w: (F.length(w) >= MIN_WORD_CHARS) & ~w.isin(stops) if stops else F.length(w) >= MIN_WORD_CHARS)


def clean_text(c, stop_words: Iterable[str] | None = None) -> Column:
    """F8: cleaned words joined by single blanks."""
    return F.array_join(clean_tokens(c, stop_words), " ")


def strip_label(c) -> Column:
    """trim all (Unicode) white space around a generated label; ``trim``
    only strips blanks, not newlines."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def title_from_slug(c) -> Column:
    """underscores to blanks, title case."""
    return F.initcap(F.replace(_c(c), F.lit("_"), F.lit(" ")))


def repo_key(account="account", name="name") -> Column:
    """``account/name`` for display."""
    return F.concat_ws("/", _c(account), _c(name))


def vector_to_text(c) -> Column:
    """vector as list text (export only)."""
    return F.to_json(_c(c))


def first_line(c) -> Column:
    return F.substring_index(_c(c), "\n", 1)
