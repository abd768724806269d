"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word enters as a vector of its own (hashed) and the mean of vectors of its
character n-grams (hashed); two gated recurrent layers read a window of words
in either direction, attention pools their states, and a logistic unit gives
the window's logit. All overlapping windows of a text are scored and the
highest counts. The network is trained in numpy, on the driver, from a sample
of labelled rows of fixed size; scoring is one narrow pass over the texts."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, sql_schema
from tessera.llm.quality import held_out

#: Words of a window, and from one window to the next.
WINDOW, STEP = 48, 32
#: Hash buckets, numbers of a word's vector and of its n-grams' mean, states of a direction, attention units.
BUCKETS, DIM, STATES, ATTENTION = 1 << 17, 8, 8, 8
GRAMS = (3, 4)
#: The sample: rows of each label at most, the longest text that is learnt from
#: and all texts of a label together (in code points). All texts are scored whole.
SAMPLE, SAMPLE_CHARS, SAMPLE_TOTAL = 2000, 50_000, 10_000_000
#: Rounds of choosing windows; windows that a round learns from (a small sample
#: is gone through again, at most EPOCHS times); batch and step.
ROUNDS, LEARNT, EPOCHS, BATCH, RATE = 2, 14_000, 8, 128, 0.02
#: Share of a batch's words whose own vector is hidden.
HIDDEN = 0.8
#: Words whose vectors a task remembers, and windows that it scores at once.
WORDS, TOGETHER = 200_000, 2048
#: Words whose vectors are made at once.
WORDS_AT_ONCE = 1 << 14
#: The longest word that is read as one, and the pieces of longer ones.
LONG, PIECE = 64, 16
_STRIP = ".,;:!?\"'()[]{}<>*_-"


def split_words(text: str) -> list[str]:
    """Words of a text. One of more than LONG characters (a text without white
    space) is read in pieces, each in its own place; they overlap, so that every
    n-gram lies whole in one."""
    words = text.split()
    if max(map(len, words), default=0) <= LONG:
        return words
    over, out = max(GRAMS) - 1, []
    for w in words:
        if len(w) <= LONG:
            out.append(w)
        else:
            out += [w[k : k + PIECE] for k in range(0, len(w) - over, PIECE - over)]
    return out


def word_keys(word: str) -> tuple[int, list[int]]:
    """A word's bucket and those of its character n-grams."""
    word = word.lower().strip(_STRIP)
    marked = f"^{word}$"
    grams = [zlib.crc32(marked[i : i + n].encode("utf-8", "replace")) % BUCKETS for n in GRAMS for i in range(len(marked) - n + 1)]
    return zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS, grams or [0]


@dataclass
class Words:
    """Distinct words with their buckets; number 0 pads."""

    number: dict[str, int] = field(default_factory=lambda: {"": 0})
    own: array = field(default_factory=lambda: array("i", [0]))
    grams: array = field(default_factory=lambda: array("i", [0]))
    begin: array = field(default_factory=lambda: array("i", [0, 1]))  # of each word's n-grams, and the end

    def numbers(self, words: list[str]) -> np.ndarray:
        for w in dict.fromkeys(words):
            if w not in self.number:
                self.number[w] = len(self.own)
                own, grams = word_keys(w)
                self.own.append(own)
                self.grams.extend(grams)
                self.begin.append(len(self.grams))
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int32, count=len(words))

    def buckets(self, first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words from ``first`` on: buckets, n-gram buckets of all, and
        where each word's n-grams begin."""
        begin = np.array(self.begin[first:-1])
        return np.array(self.own[first:]), np.array(self.grams[self.begin[first] :]), begin - self.begin[first]


def windows(n: int) -> np.ndarray:
    """Where the windows of a text of n words begin; the last reaches its end."""
    return np.arange(max(1, -(-(n - WINDOW) // STEP) + 1)) * STEP


def window_table(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(windows x WINDOW word numbers, 0 behind the end; text of each window)."""
    flat = np.concatenate([np.zeros(0, dtype=np.int32), *texts, np.zeros(WINDOW, dtype=np.int32)])
    begins, ends, of, at = [], [], [], 0
    for k, t in enumerate(texts):
        w = windows(len(t))
        begins.append(w + at)
        of.append(np.full(len(w), k))
        at += len(t)
        ends.append(np.full(len(w), at))
    if not begins:
        return np.zeros((0, WINDOW), dtype=np.int32), np.zeros(0, dtype=np.int64)
    begin, end, out = np.concatenate(begins), np.concatenate(ends), np.empty((WINDOW, sum(map(len, of))), dtype=np.int32)
    for t in range(WINDOW):
        out[t] = np.where(begin + t < end, flat[np.minimum(begin + t, len(flat) - 1)], 0)
    return out.T, np.concatenate(of)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters, forward and backward pass."""

    def __init__(self, seed: int = 4):
        rng = np.random.default_rng(seed)
        f = lambda *s, scale: (rng.normal(size=s) * scale).astype(np.float32)
        self.p = {
            "word": f(BUCKETS, DIM, scale=0.05), "gram": f(BUCKETS, DIM, scale=0.05),
            "wx": f(2 * DIM, 6 * STATES, scale=0.3), "b": np.zeros(6 * STATES, np.float32),
            "u0": f(STATES, 3 * STATES, scale=0.3), "u1": f(STATES, 3 * STATES, scale=0.3),
            "a": f(2 * STATES, ATTENTION, scale=0.3), "ab": np.zeros(ATTENTION, np.float32), "v": f(ATTENTION, scale=0.3),
            "o": f(2 * STATES, scale=0.3), "ob": np.zeros(1, np.float32),
        }
        self.scale, self.shift = 1.0, 0.0  # of the logits, fitted at last

    # Inputs ------------------------------------------------------------
    def inputs(self, own: np.ndarray, flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Vectors of words: ``flat`` holds all their n-grams, ``begin`` where
        each word's begin."""
        ends, out = np.append(begin, len(flat)), np.empty((len(own), 2 * DIM), self.p["gram"].dtype)
        out[:, :DIM] = self.p["word"][own]
        for k in range(0, len(own), WORDS_AT_ONCE):
            part = ends[k : k + WORDS_AT_ONCE + 1]
            total = np.add.reduceat(self.p["gram"][flat[part[0] : part[-1]]], part[:-1] - part[0], axis=0)
            out[k : k + WORDS_AT_ONCE, DIM:] = total / np.diff(part)[:, None]
        return out

    def gates(self, x: np.ndarray) -> np.ndarray:
        return x @ self.p["wx"] + self.p["b"]

    # Recurrence ----------------------------------------------------------
    def _run(self, gates: np.ndarray, ids: np.ndarray, way: int, keep: list | None) -> np.ndarray:
        """States (WINDOW, windows, STATES) of one direction."""
        s, u = STATES, self.p[f"u{way}"]
        own = np.ascontiguousarray(gates[:, 3 * s * way : 3 * s * (way + 1)])
        h, out = np.zeros((len(ids), s), np.float32), np.empty((WINDOW, len(ids), s), np.float32)
        for t in range(WINDOW) if way == 0 else range(WINDOW - 1, -1, -1):
            a, r = own.take(ids[:, t], axis=0), h @ u
            zr = a[:, : 2 * s] + r[:, : 2 * s]  # then the logistic function, in place
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            z, reset, q = zr[:, :s], zr[:, s:], r[:, 2 * s :]
            n = reset * q
            n += a[:, 2 * s :]
            np.tanh(n, out=n)
            if keep is not None:
                keep.append((t, h, z, reset, q, n))
            h = h - n
            h *= z
            h += n
            out[t] = h
        return out

    def _pool(self, states: np.ndarray, ids: np.ndarray):
        hidden = np.tanh(states @ self.p["a"] + self.p["ab"])
        e = hidden @ self.p["v"]
        e = np.where((ids > 0).T | (np.arange(WINDOW) == 0)[:, None], e, -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = (w[:, :, None] * states).sum(axis=0)
        return hidden, w, pooled, pooled @ self.p["o"] + self.p["ob"][0]

    def logits(self, gates: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Logits of windows of word numbers, given the gates' inputs by word."""
        out = [np.zeros(0, np.float32)]
        for k in range(0, len(ids), TOGETHER):
            part = ids[k : k + TOGETHER]
            states = np.concatenate([self._run(gates, part, w, None) for w in (0, 1)], axis=2)
            out.append(self._pool(states, part)[3])
        return np.concatenate(out)

    def gradient(self, own, flat, begin, ids, y, seen=1.0) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of windows and its gradient; the tables' by the
        words of this batch alone. ``seen``: 0 for words whose own vector is
        hidden, so that their n-grams must do."""
        s, p = STATES, self.p
        x = self.inputs(own, flat, begin)
        x[:, :DIM] *= np.reshape(seen, (-1, 1))
        gates, keep = self.gates(x), ([], [])
        states = np.concatenate([self._run(gates, ids, w, keep[w]) for w in (0, 1)], axis=2)
        hidden, w, pooled, logit = self._pool(states, ids)
        prob = _sigmoid(logit)
        d = ((prob - y) / len(y)).astype(np.float32)
        g = {"o": pooled.T @ d, "ob": np.array([d.sum()])}
        d_pooled = d[:, None] * p["o"]
        d_states = w[:, :, None] * d_pooled
        d_w = (states * d_pooled).sum(axis=2)
        d_e = w * (d_w - (w * d_w).sum(axis=0))
        g["v"] = np.einsum("tb,tba->a", d_e, hidden)
        d_hidden = d_e[:, :, None] * p["v"] * (1 - hidden**2)
        g["a"], g["ab"] = np.einsum("tbs,tba->sa", states, d_hidden), d_hidden.sum(axis=(0, 1))
        d_states = d_states + d_hidden @ p["a"].T
        d_gates = np.zeros_like(gates)
        for way in (0, 1):
            u, d_u, carry = p[f"u{way}"], np.zeros_like(p[f"u{way}"]), np.zeros((len(ids), s), np.float32)
            each = np.empty((WINDOW, len(ids), 3 * s), np.float32)
            for t, h, z, reset, q, n in reversed(keep[way]):
                dh = d_states[t, :, s * way : s * (way + 1)] + carry
                d_n = dh * (1 - z) * (1 - n**2)
                d_z = dh * (h - n) * z * (1 - z)
                d_r = d_n * q * reset * (1 - reset)
                each[t] = np.concatenate([d_z, d_r, d_n], axis=1)
                back = np.concatenate([d_z, d_r, d_n * reset], axis=1)
                d_u += h.T @ back
                carry = dh * z + back @ u.T
            g[f"u{way}"] = d_u
            where = ids.T.ravel()
            for c in range(3 * s):
                d_gates[:, 3 * s * way + c] = np.bincount(where, weights=each[:, :, c].ravel(), minlength=len(gates))
        g["wx"], g["b"] = x.T @ d_gates, d_gates.sum(axis=0)
        d_x = d_gates @ p["wx"].T
        n = np.diff(np.append(begin, len(flat)))
        g["word"] = (own, d_x[:, :DIM] * np.reshape(seen, (-1, 1)))
        g["gram"] = (flat, np.repeat(d_x[:, DIM:] / n[:, None], n, axis=0))
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        return loss, g


class Adam:
    """Adam steps; of the tables, only the rows that a batch has used move."""

    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, d in g.items():
            rows = slice(None)
            if isinstance(d, tuple):
                rows, place = np.unique(d[0], return_inverse=True)
                d = np.stack([np.bincount(place, weights=d[1][:, c], minlength=len(rows)) for c in range(DIM)], axis=1)
            self.m[k][rows] = m = 0.9 * self.m[k][rows] + 0.1 * d
            self.v[k][rows] = v = 0.999 * self.v[k][rows] + 0.001 * d * d
            self.p[k][rows] -= self.rate * fix * m / (np.sqrt(v) + 1e-8)


def _odds(seen: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Shrunken log odds of each bucket, by the texts that hold it."""
    counts = np.zeros((2, BUCKETS))
    for s, label in zip(seen, y, strict=True):
        counts[int(label)][s] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()]) + 1.0
    odds = np.log((counts[1] + 0.5) / n[1]) - np.log((counts[0] + 0.5) / n[0])
    total = counts.sum(axis=0)
    return odds * total / (total + 20)


def train(texts: list[str], y: np.ndarray, weights: tuple[float, float] = (1.0, 1.0), seed: int = 4) -> Network:
    """Fit a network. The first number of each table's vectors starts at the
    log odds of its bucket; in each round every text is represented by the
    windows that count for it: the one that scores highest and, for a negative,
    a random one too. ``weights``: how many labelled texts one of either label
    stands for, so that scores follow their true ratio."""
    net, words, rng = Network(seed), Words(), np.random.default_rng(seed)
    if len(y) and y.min() < y.max():
        # Texts without words, and one word of a negative text over and over,
        # are negatives: neither padding nor repetition counts by itself.
        plain = [split_words(t) for t, label in zip(texts, y, strict=True) if not label]
        plain = [t for t in plain if t]
        again = [" ".join([plain[k][rng.integers(len(plain[k]))]] * WINDOW) for k in rng.integers(0, len(plain), max(8, len(plain) // 8))] if plain else []
        more = [""] * max(8, len(texts) // 50) + again
        texts, y = [*texts, *more], np.append(y, np.zeros(len(more), np.float32))
    if not len(y) or y.min() == y.max():
        net.scale, net.shift = 0.0, (0.0 if not len(y) else 4.0 * (2 * y[0] - 1))
        return net
    numbers = [words.numbers(split_words(t)) for t in texts]
    own, flat, begin = words.buckets()
    size = np.diff(np.append(begin, len(flat)))
    distinct = [np.unique(n) for n in numbers]
    net.p["word"][:, 0] = _odds([np.unique(own[d]) for d in distinct], y)
    net.p["gram"][:, 0] = _odds([np.unique(flat[np.repeat(begin[d], size[d]) + np.arange(size[d].sum()) - np.repeat(np.cumsum(size[d]) - size[d], size[d])]) if len(d) else d for d in distinct], y)
    ids, of = window_table(numbers)
    hint = net.inputs(own, flat, begin)[:, [0, DIM]].sum(axis=1)
    hint[0] = -9
    logit = np.concatenate([np.sort(hint[ids[k : k + TOGETHER]], axis=1)[:, -2:].sum(axis=1) for k in range(0, len(ids), TOGETHER)])
    adam = Adam(net.p, RATE)
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    for _ in range(ROUNDS):
        best = np.array([first[k] + np.argmax(logit[first[k] : first[k + 1]]) for k in range(len(texts))])
        some = first[:-1] + rng.integers(0, np.diff(first))
        chosen = np.concatenate([best, some[y == 0]])
        label = y[of[chosen]]
        for _ in range(min(EPOCHS, -(-LEARNT // len(chosen)))):
            order = rng.permutation(len(chosen))
            for k in range(0, len(order), BATCH):
                part = order[k : k + BATCH]
                used, place = np.unique(ids[chosen[part]], return_inverse=True)
                place = place.reshape(len(part), WINDOW)
                if used[0] != 0:  # number 0 stays the padding
                    used, place = np.append(0, used), place + 1
                at = np.repeat(begin[used], size[used]) + np.arange(size[used].sum()) - np.repeat(np.cumsum(size[used]) - size[used], size[used])
                seen = (rng.random(len(used)) >= HIDDEN).astype(np.float32)
                _, g = net.gradient(own[used], flat[at], np.cumsum(size[used]) - size[used], place, label[part], seen)
                adam.step(g)
        logit = net.logits(net.gates(net.inputs(own, flat, begin)), ids)
    top = np.maximum.reduceat(logit, first[:-1])
    # A logistic fit of the texts' highest logits, at the true ratio of labels.
    a, b = 1.0, 0.0
    stands = np.where(y == 1, weights[1], weights[0])
    stands = stands / stands.mean()
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30)))
        w = stands * (q * (1 - q) + 1e-3)
        h = np.array([[(w * top * top).sum() + 1, (w * top).sum()], [(w * top).sum(), w.sum() + 1e-3]])
        e = stands * (q - y)
        step = np.linalg.solve(h, [(e * top).sum() + (a - 1), e.sum()])
        a, b = max(0.05, a - 0.5 * step[0]), b - 0.5 * step[1]
    net.scale, net.shift = float(a), float(b)
    return net


class Scorer:
    """Scores of whole texts; remembers the gates' inputs by word."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.words, self.gates = Words(), np.zeros((0, 6 * STATES), np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.words.own) > WORDS:
            self.forget()
        numbers = [self.words.numbers(split_words(t)) for t in texts]
        if len(self.words.own) > len(self.gates):
            more = self.net.gates(self.net.inputs(*self.words.buckets(len(self.gates))))
            self.gates = np.concatenate([self.gates, more])
        ids, of = window_table(numbers)
        logit = self.net.logits(self.gates, ids)
        top = np.maximum.reduceat(logit, np.searchsorted(of, np.arange(len(texts))))
        return 1 / (1 + np.exp(-np.clip(self.net.scale * top + self.net.shift, -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, label: str) -> tuple[list[str], np.ndarray, tuple[float, float]]:
    """Up to SAMPLE labelled texts of either label that are not held out and
    have up to SAMPLE_CHARS code points, in the order of a hash of doc_id for as
    long as they have SAMPLE_TOTAL together; and how many such texts one of
    either label stands for. Of rows of one doc_id, one text is learnt from."""
    marked = labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.length("text") <= SAMPLE_CHARS).filter(~held_out(F.col("doc_id")))
    sizes = rows.select("doc_id", F.length("text").alias("size")).join(marked, F.col("doc_id") == F.col("l_id"))
    ids = cut_lineage(sizes.groupBy("doc_id", "y").agg(F.max("size").alias("size")))  # counted and drawn from
    count = {r.y: r["count"] for r in ids.groupBy("y").count().collect()}
    chosen = []
    for value in (0, 1):
        part = ids.filter(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()
        total = np.cumsum([r["size"] for r in part])
        chosen += part[: int(np.searchsorted(total, SAMPLE_TOTAL, side="right"))]
    # 2 x SAMPLE ids at most, so they are broadcast and the texts don't move.
    drawn = docs.sparkSession.createDataFrame(chosen, ids.schema).select(F.col("doc_id").alias("c_id"), "y")
    got = rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("c_id"))
    got = got.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")).orderBy("doc_id", "y").collect()
    y = np.array([r.y for r in got], dtype=np.float32)
    return [r.text for r in got], y, tuple(count.get(k, 0) / max(1, int((y == k).sum())) for k in (0, 1))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    A null text counts as empty and is scored as one window without words; a
    null doc_id is not held out and has no label; repeated rows are scored
    alike. A text of any length is scored whole, window by window, and its score
    is the highest; a word of over 64 characters is read in overlapping pieces.
    Texts of over 50,000 code points are only left out of learning. Further
    columns are ignored. Without labels of both kinds, all
    scores are the same. An empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(train(*sample(docs, labels, label)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            out, held, chars = [], [], 0
            for t in batch.column(1):
                text = t.as_py() or ""
                if held and chars + len(text) > 1 << 18:
                    out.append(scorer.scores(held))
                    held, chars = [], 0
                held.append(text)
                chars += len(text)
            if held:
                out.append(scorer.scores(held))
            scores = np.concatenate([np.zeros(0), *out])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    read = docs.select("doc_id", "text")
    scored = read.mapInArrow(run, sql_schema(read.select("doc_id"), ("score", "double")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
