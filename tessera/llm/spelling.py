"""Spelling variants by finite-state composition.

The near pairs of a vocabulary are what its acceptor, composed with a one-edit
transducer and with the acceptor again, accepts. The composition is cut by its
initial states: two words at one edit agree before or behind the edit, so they
share the first half or the second half of the shorter one. Words with such a
half in common form a group; its initial state is the state that the half leads
to. In a group the rests of the words become minimised acyclic acceptors, one
for the shorter and one for the longer words, and the composition runs over
them: matched arcs until the edit, the edit's arc, matched arcs behind it.

A group of more than ``GROUP`` words is cut again in the same way, half by half
of what is left; with one letter left to differ a group cannot be larger. A word
sums up its pairs in the task; pairs are never rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage

LETTERS = r"[a-zÀ-ÿ]+"  # of texts with A-Z lowered
LEAST, TWICE, TIMES = 7, 2, 10
#: Words of a group. All words that differ in one letter, or also in one more,
#: are 90 + 90 * 90 at most.
GROUP = 1 << 14
#: Different words that a task holds to add up their counts.
HELD = 1 << 19


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n), added up in the task as far as ``HELD`` goes."""
    run = re.compile(LETTERS)
    held: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if not text.is_valid:
                continue
            # Lowering the bytes changes A-Z alone.
            low = text.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for word, n in Counter(w for m in run.finditer(low) if len(w := m.group()) >= LEAST).items():
                h = zlib.crc32(word.encode(), before)
                if h % 31 == 0:
                    word = word[: h % len(word)] + word[h % len(word) + 1 :]
                    if len(word) < LEAST:
                        continue
                held[word] += n
            if len(held) >= HELD:
                yield flushed()
                held = Counter()
    yield flushed()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts that occur at least twice."""
    counted = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(_words, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= TWICE)


class Acceptor:
    """The minimised acyclic acceptor of sorted words of one length."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self._known: dict[tuple, int] = {}
        path, last = [0], ""
        for word in words:
            same = 0
            for a, b in zip(last, word, strict=False):
                if a != b:
                    break
                same += 1
            self._close(path, last, same)
            del path[same + 1 :]
            for letter in word[same:]:
                self.arcs.append({})
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            last = word
        self._close(path, last, 0)

    def _close(self, path: list[int], word: str, down_to: int) -> None:
        """States that get no more arcs: equal ones become one."""
        for depth in range(len(word), down_to, -1):
            state = path[depth]
            self.arcs[path[depth - 1]][word[depth - 1]] = self._known.setdefault(tuple(self.arcs[state].items()), state)


def _shared(left: list[dict], p: int, right: list[dict], q: int, depth: int, not_first: str = "") -> Iterator[str]:
    """The strings of ``depth`` letters that lead from both states to the end,
    but those that begin with ``not_first``."""
    if depth == 0:
        yield ""
        return
    letters: list[str] = []
    stack = [(p, q, 0, "")]
    while stack:
        p, q, at, letter = stack.pop()
        if at:
            del letters[at - 1 :]
            letters.append(letter)
        if at == depth:
            yield "".join(letters)
            continue
        a, b = left[p], right[q]
        for c in a if len(a) <= len(b) else b:
            if c in a and c in b and not (at == 0 and c == not_first):
                stack.append((a[c], b[c], at + 1, c))


def near_pairs(words: list[str]) -> Iterator[tuple[str, str]]:
    """Every pair of different words at exactly one edit once, of which the
    shorter has the least length in ``words``; the others have that length or one more."""
    least = min(map(len, words))
    short = sorted(w for w in words if len(w) == least)
    long = sorted(w for w in words if len(w) == least + 1)
    if len(short) > 1:  # replaced
        arcs = Acceptor(short).arcs
        letters: list[str] = []
        stack = [(0, 0, "")]
        while stack:
            p, at, letter = stack.pop()
            if at:
                del letters[at - 1 :]
                letters.append(letter)
            out = list(arcs[p].items())
            for i, (c, to_c) in enumerate(out):
                for d, to_d in out[i + 1 :]:
                    for rest in _shared(arcs, to_c, arcs, to_d, least - at - 1):
                        before = "".join(letters)
                        yield before + c + rest, before + d + rest
                stack.append((to_c, at + 1, c))
    if short and long:  # inserted, as late as the word allows
        one, two = Acceptor(short).arcs, Acceptor(long).arcs
        letters = []
        pairs = [(0, 0, 0, "")]
        while pairs:
            p, q, at, letter = pairs.pop()
            if at:
                del letters[at - 1 :]
                letters.append(letter)
            for c, to in two[q].items():
                for rest in _shared(one, p, two, to, least - at, not_first=c):
                    before = "".join(letters)
                    yield before + rest, before + c + rest
                if c in one[p]:
                    pairs.append((one[p][c], to, at + 1, c))


def _group(words: list[str], counts: list[int], head: int, tail: int, apart: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, their largest n, that word) of a group's words. Pairs
    that share their first ``apart`` letters belong to another group."""
    rest = {w[head : len(w) - tail]: k for k, w in enumerate(words)}
    near, best = [0] * len(words), [None] * len(words)
    for x, y in near_pairs(list(rest)):
        if apart > head and x[: apart - head] == y[: apart - head]:
            continue
        i, j = rest[x], rest[y]
        for a, b in ((i, j), (j, i)):
            near[a] += 1
            mine = (-counts[b], words[b])
            if best[a] is None or mine < best[a]:
                best[a] = mine
    for k, n in enumerate(near):
        if n:
            yield words[k], n, -best[k][0], best[k][1]


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, least, head, tail, apart, word, n) come sorted by key."""
    def settled(rows: list[tuple]) -> Iterator[tuple]:
        groups: dict[tuple, list] = {}
        for _, least, head, tail, apart, word, n in rows:  # keys are hashes: told apart here
            groups.setdefault((least, head, tail, apart), []).append((word, n))
        for (least, head, tail, apart), members in groups.items():
            if len(members) > 1 and any(len(w) == least for w, _ in members):
                yield from _group([w for w, _ in members], [n for _, n in members], len(head), len(tail), apart)

    def packed(found: list[tuple]) -> pa.RecordBatch:
        word, near, n, best = zip(*found, strict=True) if found else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], names=["word", "n_near", "best_n", "best"])

    open_: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        ends = np.append(begins[1:], len(key))
        found: list[tuple] = []
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            last = e == len(key)
            if open_ and open_[0][0] != key[b]:
                found += settled(open_)
                open_ = []
            if e - b > 1 or last or open_:
                part = batch.slice(b, e - b)
                open_ += zip(*(c.to_pylist() for c in part.columns), strict=True)
                if not last:
                    found += settled(open_)
                    open_ = []
        yield packed(found)
    yield packed(list(settled(open_)))


def _halves(words: DataFrame) -> DataFrame:
    """Each word with the initial states it starts from: first and second half,
    for partners of its own length or longer, and for shorter ones."""
    size = F.length("word")
    for_least = F.explode(F.when(size > LEAST, F.array(size, size - 1)).otherwise(F.array(size))).alias("least")
    first = words.select("word", "n", for_least).withColumn("half", F.floor(F.col("least") / 2).cast("int"))
    none = F.lit("")
    return _keyed(first, F.struct(F.left("word", F.col("half")).alias("head"), none.alias("tail"), F.lit(0).alias("apart")),
                  F.struct(none.alias("head"), F.right("word", F.col("least") - F.col("half")).alias("tail"), F.col("half").alias("apart")))


def _quarters(words: DataFrame) -> DataFrame:
    """The words of groups that are too large, by half of what is left to differ."""
    left = F.col("least") - F.length("head") - F.length("tail")
    cut = words.withColumn("half", (F.length("head") + F.floor(left / 2)).cast("int"))
    return _keyed(cut, F.struct(F.left("word", F.col("half")).alias("head"), "tail", "apart"),
                  F.struct("head", F.right("word", F.col("least") - F.col("half")).alias("tail"), F.col("half").alias("apart")))


def _keyed(words: DataFrame, before, behind) -> DataFrame:
    start = words.select("word", "n", "least", F.explode(F.array(before, behind)).alias("state")).select("least", "state.*", "word", "n")
    return start.select(F.xxhash64("least", "head", "tail", "apart").alias("key"), "*")


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n_near, best_n, best) of every word of ``words`` (word, n) that has
    a near one: their number and the one of largest n, least on ties."""
    start, found = _halves(words), []
    while True:
        large = start.groupBy("key").count().filter(F.col("count") > group).select("key")
        large = cut_lineage(large)
        more = not large.isEmpty()
        # What is left to differ is a letter: cannot be cut, and is small enough.
        over = (start.join(large, "key", "left_semi").filter(F.col("least") - F.length("head") - F.length("tail") > 1)) if more else None
        fit = start.join(large.withColumn("large", F.lit(True)), "key", "left").filter(F.col("large").isNull() | (F.col("least") - F.length("head") - F.length("tail") <= 1)).drop("large") if more else start
        sorted_ = fit.repartition("key").sortWithinPartitions("key", "least", "head", "tail", "apart", "word")
        found.append(sorted_.mapInArrow(_compose, "word string, n_near long, best_n long, best string"))
        if not more:
            break
        found[-1] = cut_lineage(found[-1])
        start = cut_lineage(_quarters(over))
    links = found[0]
    for f in found[1:]:
        links = links.unionByName(f)
    least = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return links.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("top")).select("word", "n_near", (-F.col("top.minus")).alias("best_n"), F.col("top.word").alias("best"))


def spelling_variants(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    Words are the runs of letters of whole texts, A-Z lowered, with one letter
    taken out where the checksum of doc_id and run asks for it (a null doc_id is
    an empty string), of ``LEAST`` code points and ``TWICE`` occurrences at least.
    The form is the near word of largest n, of least code points on ties, where
    that n is at least ``TIMES`` the word's; the root is where forms lead. Null
    and empty texts have no words; repeated rows count each; a run of any length
    is one word; further columns are ignored; an empty table gives an empty one."""
    words = cut_lineage(vocabulary(docs))
    near = cut_lineage(near_words(words, group))
    formed = F.col("best_n") >= TIMES * F.col("n")
    named = words.join(near, "word", "left").select(
        "word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best_n")).alias("form_n")
    )
    named = cut_lineage(named)
    roots = cut_lineage(named.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:  # a form is TIMES as frequent, so the ways are short; each round doubles what was gone
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        gone = cut_lineage(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = gone.select("word", "root")
        if gone.filter("moved").isEmpty():
            break
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
