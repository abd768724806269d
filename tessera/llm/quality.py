"""Quality classifier: random Fourier features of document statistics, ridge
scores from partition-summed normal equations, isotonic calibration.

The features cos(Wx + b) approximate a Gaussian kernel over the standardised
statistics. Each task sums its rows' normal equations, one set for each fold of
the training rows; sums add up in two steps. Solving without a fold scores that
fold, and a pooled fit of these scores against the labels (binned, so its size
is fixed) turns scores into probabilities."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import per_batch, sql_schema

#: Random features, ridge penalty for each training row, width of the kernel
#: in square roots of the number of statistics.
FEATURES, RIDGE, WIDTH = 192, 1e-4, 0.7
#: Bins of the isotonic fit, and the range of raw scores that they cover.
BINS, LOW, HIGH = 1000, -0.5, 1.5
#: Tasks that add up the tasks' sums.
SUMMED_BY = 8
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_spread", "letters", "digits", "spaces", "upper", "marks", "symbols",
    "high_bytes", "entropy", "distinct_words", "top_word", "one_letter", "line_length", "repeated_lines", "short_lines",
    "sentence_ends", "symbol_runs", "longest_word", "capital_words", "repeated_pairs", "squeeze",
)
_KIND = np.zeros(256, dtype=np.int64)  # 0 other, 1 letter, 2 digit, 3 space, 4 upper, 5 mark, 6 symbol, 7 high
for _chars, _kind in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"0123456789", 2), (b" \t\n\r\x0b\x0c", 3), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 4), (b".,;:!?'\"()-", 5), (b"#$%&*+/<=>@[\\]^_`{|}~", 6), (bytes(range(128, 256)), 7)):
    _KIND[np.frombuffer(_chars, dtype=np.uint8)] = _kind
_RUN = re.compile(rb"[^\w\s\x80-\xff]{2,}")


def statistics(text: str) -> np.ndarray:
    """The statistics of a whole text; all 0 for an empty one."""
    out = np.zeros(len(STATISTICS))
    data = text.encode("utf-8", "replace")
    if not data:
        return out
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=8) / len(data)
    p = counts[counts > 0] / len(data)
    words, lines = data.split(), [x for x in data.split(b"\n") if x]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    seen, pairs = Counter(words), len(set(zip(words, words[1:], strict=False)))
    ends = data.count(b".") + data.count(b"!") + data.count(b"?")
    letters = kinds[1] + kinds[4] + kinds[7]
    out[:] = (
        math.log1p(len(text)), math.log1p(len(words)), min(40.0, lengths.mean()), min(40.0, lengths.std()),
        letters, kinds[2], kinds[3], kinds[4] / max(letters, 1e-9), kinds[5], kinds[6],
        kinds[7], -(p * np.log2(p)).sum(), len(seen) / n ** 0.9, max(seen.values(), default=0) / n, float((lengths == 1).mean()),
        math.log1p(len(data) / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), float(np.mean([len(x) < 30 for x in lines])) if lines else 0.0,
        ends / n, len(_RUN.findall(data)) / n, math.log1p(lengths.max()), sum(w[:1].isupper() for w in words) / n, 1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        math.log1p(len(words) / max(1, len(seen))),
    )
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every row, one row each: a null text counts as
    empty, repeated rows and null ids stay, texts of any length are read whole,
    other columns are ignored."""

    def make():
        def work(batch):
            rows = [pa.array(statistics(t.as_py() or "")) for t in batch.column(1)]
            values = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(STATISTICS)), pa.concat_arrays(rows) if rows else pa.array([], pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["doc_id", "x"])

        return work

    return per_batch(docs.select("doc_id", "text"), make, sql_schema(docs.select("doc_id"), ("x", "array<double>")))


@dataclass
class KernelModel:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b
        return np.concatenate([np.sqrt(2 / len(self.b)) * np.cos(z), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores, 0 to 1."""
        return np.interp(self.raw(x), self.knots, self.values)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _sums(rows: DataFrame, model: KernelModel, folds: int) -> list[np.ndarray]:
    """Z'Z and Z'y of each fold: summed by task, then by SUMMED_BY tasks."""
    size = len(model.b) + 1

    def by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, size, size + 1))
        for batch in batches:
            z, y, fold = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for f in range(folds):
                total[f] += z[fold == f].T @ np.concatenate([z, y[:, None]], axis=1)[fold == f]
        for f in range(folds):
            yield pa.RecordBatch.from_pydict({"fold": [f], "total": [total[f].ravel()]})

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for f, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[f] = total.get(f, 0) + part.values.to_numpy()
        for f, x in total.items():
            yield pa.RecordBatch.from_pydict({"fold": [f], "total": [x]})

    schema = "fold long, total array<double>"
    parts = rows.select("x", "y", "fold").mapInArrow(by_task, schema)
    out = [np.zeros((size, size + 1)) for _ in range(folds)]
    for r in parts.repartition(SUMMED_BY).mapInArrow(together, schema).toLocalIterator():  # SUMMED_BY x folds rows
        out[r.fold] += np.asarray(r.total).reshape(size, size + 1)
    return out


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (centres of the pools) and values."""
    pools: list[list[float]] = []  # sum of n * y, n, sum of n * x
    for a, b, c in zip(x, y, n, strict=True):
        pools.append([b * c, c, a * c])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, seed: int = 9) -> KernelModel:
    """Learn from the rows of ``stats`` (doc_id, x) that ``labels`` marks 0 or
    1 in column ``label`` and that are not held out. Null ids and other labels
    are not used; repeated rows count each. Without any label all scores are
    0.5."""
    marked = labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("double").alias("y")).filter("y in (0, 1)")
    rows = stats.join(marked, stats["doc_id"] == marked["l_id"]).filter(~held_out(F.col("doc_id")))
    rows = rows.select("x", "y", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)).cast("long").alias("m"))
    rows = rows.select("x", "y", (F.pmod(F.col("m") - 1, F.lit(folds))).cast("long").alias("fold"))
    d = len(STATISTICS)
    sums = rows.agg(F.count("*"), *(f(F.col("x")[i] ** p) for f, p in ((F.sum, 1), (F.sum, 2)) for i in range(d))).first()
    n = sums[0]
    rng = np.random.default_rng(seed)
    w, b = rng.normal(size=(d, FEATURES)) / (WIDTH * math.sqrt(d)), rng.uniform(0, 2 * math.pi, FEATURES)
    model = KernelModel(np.zeros(d), np.ones(d), w, b, np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    if not n:
        return model
    model.mean = np.array(sums[1 : d + 1]) / n
    model.scale = np.sqrt(np.maximum(np.array(sums[d + 1 :]) / n - model.mean**2, 0)) + 1e-6
    each = _sums(rows, model, folds)
    penalty = np.diag(np.append(np.full(FEATURES, RIDGE * n), 1e-9))

    def solve(total: np.ndarray) -> np.ndarray:
        return np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    whole = sum(each)
    model.weights = solve(whole)
    others = [solve(whole - e) if (whole - e)[-1, -2] > 0 else model.weights for e in each]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = model.features(_matrix(batch.column(0))), batch.column(2).to_numpy()
            raw = np.einsum("ij,ij->i", z, np.asarray(others)[fold])
            place = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], names=["bin", "y"])

    bins = rows.select("x", "y", "fold").mapInArrow(binned, "bin long, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()  # BINS rows at most
    x = LOW + (np.array([r.bin for r in bins]) + 0.5) * (HIGH - LOW) / BINS
    model.knots, model.values = isotonic(x, np.array([r.y / r.n for r in bins]), np.array([r.n for r in bins], dtype=float))
    return model


def score(stats: DataFrame, model: KernelModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``stats``; equal
    texts score alike, a null doc_id is not held out, an empty table gives an
    empty one."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(batch):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(_matrix(batch.column(1))))], names=["doc_id", "score"])

        return work

    scored = per_batch(stats.select("doc_id", "x"), make, sql_schema(stats.select("doc_id"), ("score", "double")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_poor(docs: DataFrame, model: KernelModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, in one pass.
    A null text is scored as an empty one; all columns stay as they are."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def make():
        def work(batch):
            stats = np.array([statistics(t.as_py() or "") for t in batch.column(place)]).reshape(-1, len(STATISTICS))
            yield batch.filter(pa.array(shared.value.score(stats) >= threshold))

        return work

    return per_batch(docs, make, docs.schema)
