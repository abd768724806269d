"""Splitting texts into the pre-tokens that byte-level BPE merges within."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import regex

#: Texts of more characters are split piece by piece, in runs of this many pieces.
WHOLE_TEXT, RUN = 1 << 20, 1 << 16
#: Results that a memo holds.
MEMO = 500_000


def _latin(pattern: str) -> re.Pattern:
    """``pattern`` for Latin-1 texts: classes written out, for the standard
    library's engine, which is twice as fast."""

    def members(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(0x100) if regex.match(kind, chr(c)))

    inside = False

    def plain(m: re.Match) -> str:
        nonlocal inside
        if m[0] in "[]":
            inside = m[0] == "["
            return m[0]
        if m[0] == r"\S":
            return f"[^{members(r'\s')}]"
        return members(m[0]) if inside else f"[{members(m[0])}]"

    return re.compile(re.sub(r"\\p\{[LN]\}|\\s|\\S|\[|\]", plain, pattern))


class Splitter:
    """Matches of a pattern built from ``\\p{L}``, ``\\p{N}``, ``\\s``, ``\\S``
    (outside classes), literals and classes."""

    def __init__(self, pattern: str):
        self.any, self.latin = regex.compile(pattern), _latin(pattern)

    def lists(self, text: str) -> Iterator[list[str]]:
        """The matches in order, in lists of bounded size."""
        try:
            text.encode("latin-1")
            pattern = self.latin
        except UnicodeEncodeError:
            pattern = self.any
        if len(text) <= WHOLE_TEXT:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while run := [m.group() for m in islice(found, RUN)]:
            yield run


class Memo:
    """Results by pre-token. ``resolve`` takes a list of new pre-tokens and
    returns their results; the memo starts again when it holds ``most``."""

    def __init__(self, resolve, most: int = MEMO):
        self.known: dict = {}
        self.resolve, self.most = resolve, most

    def learn(self, lists: Iterable[list[str]]) -> None:
        """Afterwards the memo holds every pre-token of ``lists``."""
        wanted = set().union(*lists)
        new = list(wanted.difference(self.known))
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = list(wanted)
        self.known.update(zip(new, self.resolve(new), strict=True))

    def results(self, pieces: list[str]):
        return map(self.known.__getitem__, pieces)
