"""Text clustering.

A document's terms are counted inside its row, so no (document, term) pair is
shuffled: only the terms' document frequencies are, after each task has added up
its own. Weights and norms are made in the row as well. k-means for all K and PCA
pass over these rows; a task adds up its centres or its products, and only those
sums travel. On the driver are the vocabulary (at most ``max_features`` terms or
``MAX_DRIVER_VOCAB``), centres (a row of the vocabulary each) and a thin block of
directions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import ENGLISH_STOP_WORDS, MIN_WORD_CHARS, word_runs
from tessera.session import cut_lineage

# Vectoriser and k-means settings of the topic report.
MAX_DF = 0.95
MIN_DF = 2
MAX_FEATURES = 1000
K_MAX = 15
DEFAULT_K = 5
MAX_DRIVER_VOCAB = 262_144
#: Steps of k-means, digits that its distances are compared by, and term weights
#: of a document block that meet all centres at once.
ROUNDS, NEAR_DIGITS, BLOCK = 10, 9, 1 << 12
#: Part sums that one task adds up.
FAN = 64


@dataclass
class Tfidf:
    n_docs: int
    vocab: list[str]  # alphabetical; index = position
    idf: list[float]
    rows: DataFrame  # keys + term_index, weight (arrays; non-empty documents only)
    keys: list[str]

    def vocab_df(self) -> DataFrame:
        return self.rows.sparkSession.createDataFrame(
            [(i, t, self.idf[i]) for i, t in enumerate(self.vocab)], "term_index int, term string, idf double"
        )

    @property
    def long(self) -> DataFrame:
        """keys + term + term_index + weight, a row for each term of a document."""
        one = self.rows.select(*self.keys, F.explode(F.arrays_zip("term_index", "weight")).alias("x")).select(*self.keys, "x.*")
        return one.join(F.broadcast(self.vocab_df().drop("idf")), "term_index").select(*self.keys, "term", "term_index", "weight")


def _arrow_function(df: DataFrame, columns: Sequence[str], work: Callable[[list[pa.Array]], list[pa.Array]], schema: str) -> DataFrame:
    """``df`` with ``columns`` replaced by what ``work`` makes of them, a batch
    at a time; the others pass through."""
    rest = [c for c in df.columns if c not in columns]
    types = [T.StructField(c, df.schema[c].dataType) for c in rest]
    out = T.StructType(types + T._parse_datatype_string(schema).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = work([batch.column(c) for c in columns])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *made], names=out.names)

    return df.mapInArrow(run, out)


def _counted(stop_words: Iterable[str] | None) -> Callable[[list[pa.Array]], list[pa.Array]]:
    """The different kept terms (F8) of each document's words and how often they
    occur. What is dropped is decided once for each different word of a batch."""
    stops = list(ENGLISH_STOP_WORDS if stop_words is None else stop_words)

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        words = columns[0]
        coded = pc.dictionary_encode(words.flatten())
        sizes = np.diff(words.offsets.to_numpy())
        row = np.repeat(np.arange(len(words), dtype=np.int64), sizes)
        dropped = pc.or_(pc.less(pc.utf8_length(coded.dictionary), MIN_WORD_CHARS), pc.is_in(coded.dictionary, value_set=pa.array(stops, pa.string())))
        term = coded.indices.to_numpy()
        kept = ~dropped.to_numpy(zero_copy_only=False)[term]
        width = max(1, len(coded.dictionary))
        pair, tf = np.unique(row[kept] * width + term[kept], return_counts=True)
        offsets = pa.array(np.searchsorted(pair, np.arange(len(words) + 1, dtype=np.int64) * width).astype(np.int32))
        terms = coded.dictionary.take(pa.array(pair % width))
        return [pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))]

    return work


def _weighted(vocab: list[str], idf: list[float]) -> Callable[[list[pa.Array]], list[pa.Array]]:
    """Terms of the vocabulary with their weights, of unit length."""
    weights = np.array(idf)

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        terms, counts = columns
        known = pa.array(vocab, pa.string())
        index = pc.fill_null(pc.index_in(terms.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
        keep = index >= 0
        index, row, tf = index[keep], row[keep], counts.flatten().to_numpy()[keep]
        by = np.lexsort((index, row))
        index, row, tf = index[by], row[by], tf[by]
        raw = tf * weights[index] if len(index) else np.zeros(0)
        norm = np.sqrt(np.bincount(row, weights=raw * raw, minlength=len(terms)))
        offsets = pa.array(np.searchsorted(row, np.arange(len(terms) + 1)).astype(np.int32))
        return [pa.ListArray.from_arrays(offsets, pa.array(index.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(raw / norm[row]))]

    return work


def tfidf(df: DataFrame, text_col: str, keys: Sequence[str], stop_words: Iterable[str] | None = None,
          max_df: float = MAX_DF, min_df: int = MIN_DF, max_features: int | None = MAX_FEATURES) -> Tfidf:
    """Tf x (ln((1 + n) / (1 + df)) + 1), L2-normalised per document.

    Vocabulary: terms with df >= min_df and df <= max_df * n, then the
    ``max_features`` most frequent by corpus count (ties by term), indexed
    alphabetically. Documents whose cleaned text is empty are left out
    (P15); a document without a term of the vocabulary has no weights. Rows
    that share a key are documents of their own."""
    keys = list(keys)
    # Filtered behind the function: a filter on the words would be pushed in front
    # of the projection, which then makes them twice.
    words = df.select(*keys, word_runs(text_col).alias("__words"))
    terms = _arrow_function(words, ["__words"], _counted(stop_words), "__terms array<string>, __tf array<int>")
    counted = cut_lineage(terms.filter(F.size("__terms") > 0))
    n_docs = counted.count()
    one = counted.select(F.explode(F.arrays_zip("__terms", "__tf")).alias("x"))
    stats = one.groupBy(F.col("x.__terms").alias("term")).agg(F.count("*").alias("df"), F.sum("x.__tf").alias("total"))
    kept = stats.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_docs)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("total"), F.asc("term")).limit(max_features)
    # Bounded: one row more than may be.
    rows = sorted((r["term"], r["df"]) for r in kept.limit((max_features or MAX_DRIVER_VOCAB) + 1).collect())
    if max_features is None and len(rows) > MAX_DRIVER_VOCAB:
        raise ValueError(f"the vocabulary exceeds {MAX_DRIVER_VOCAB} terms; set max_features")
    vocab = [t for t, _ in rows]
    idf = [math.log((1.0 + n_docs) / (1.0 + d)) + 1.0 for _, d in rows]
    weighted = _arrow_function(counted, ["__terms", "__tf"], _weighted(vocab, idf), "term_index array<int>, weight array<double>")
    return Tfidf(n_docs, vocab, idf, weighted, keys)


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, term_index, weight) of a batch's rows."""
    index, weight = batch.column("term_index"), batch.column("weight")
    offsets = index.offsets.to_numpy()
    return offsets - offsets[0], index.flatten().to_numpy(), weight.flatten().to_numpy()


def _blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``BLOCK`` weights."""
    begin = 0
    while begin < len(offsets) - 1:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + BLOCK, side="right")) - 1)
        yield begin, end
        begin = end


def _times(offsets: np.ndarray, index: np.ndarray, weight: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    out = np.zeros((len(offsets) - 1, dense.shape[1]))
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        product = weight[:, None] * dense[index]
        out[some] = np.add.reduceat(product, offsets[:-1][some] - offsets[0], axis=0)
    return out


def _add_at(sums: np.ndarray, row: np.ndarray, column: np.ndarray, weight: np.ndarray) -> None:
    """Adds to places of a matrix, in order; by one index, which numpy does in a
    fraction of the time that it takes for two."""
    np.add.at(sums.reshape(-1), row.astype(np.int64) * sums.shape[1] + column, weight)


def _add_up(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sums of ``n``, ``cost`` and of the packed arrays ``sums`` by ``by``, in two
    steps, so that no task adds up those of all others."""
    import pandas as pd

    def total(group: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros(0)
        for packed in group["sums"]:
            one = np.frombuffer(packed, dtype=np.float64)
            sums = one.copy() if not len(sums) else sums + one
        first = {c: [group[c].iloc[0]] for c in by}
        return pd.DataFrame(first | {"part": [0], "n": [group["n"].sum()], "cost": [group["cost"].sum()], "sums": [sums.tobytes()]})

    names = ", ".join(f"{c} int" for c in by)
    schema = f"{names}, part int, n long, cost double, sums binary"
    some = parts.groupBy(*by, "part").applyInPandas(total, schema)
    return some.groupBy(*by).applyInPandas(total, schema)


@dataclass
class KMeansModels:
    """Centres for each K (K x vocabulary), and the cost with them."""

    centres: dict[int, np.ndarray]
    cost: dict[int, float]

    def inertia(self, spark) -> DataFrame:
        return spark.createDataFrame(sorted(self.cost.items()), "k int, inertia double")

    def long(self, spark, k: int) -> DataFrame:
        """(cluster, term_index, weight) of the centres for K."""
        rows = [(c, i, round(float(w), 12)) for c, centre in enumerate(self.centres[k]) for i, w in enumerate(centre)]
        return spark.createDataFrame(rows, "cluster int, term_index int, weight double")


def _nearest(offsets, index, weight, stacked: np.ndarray, squares: np.ndarray, ends: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each K (its centres end at ``ends``) the nearest centre of each row,
    the first of equals, and the squared distance."""
    own = np.zeros(len(offsets) - 1)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        own[some] = np.add.reduceat(weight * weight, offsets[:-1][some] - offsets[0])
    d = np.maximum(own[:, None] + squares[None, :] - 2 * _times(offsets, index, weight, stacked), 0.0)
    for begin, end in zip([0, *ends], ends, strict=False):
        c = np.round(d[:, begin:end], NEAR_DIGITS).argmin(axis=1)
        yield c, d[np.arange(len(c)), begin + c]


def kmeans(rows: DataFrame, keys: Sequence[str], width: int, ks: Sequence[int] | None = None, rounds: int = ROUNDS, written: bool = False) -> KMeansModels:
    """K-means for every K of ``ks`` (2 to 15) at once.

    The first K documents by a hash of their key are the first centres; each
    of ``rounds`` steps is one pass over the rows, in which every document meets
    the centres of all K that still move. A centre without documents stays. One
    more pass gives the costs. K above the number of documents is left out.
    ``written`` rows are a table already."""
    rows = rows if written else cut_lineage(rows)
    ks = sorted(ks if ks is not None else range(2, K_MAX + 1))
    key = F.md5(F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]))
    first = rows.orderBy(key, *keys, "term_index", "weight").limit(max(ks, default=0)).select("term_index", "weight").collect()
    centres: dict[int, np.ndarray] = {}
    for k in [k for k in ks if k <= len(first)]:
        centres[k] = np.zeros((k, width))
        for c in range(k):
            centres[k][c, first[c]["term_index"]] = first[c]["weight"]
    moving = list(centres)
    cost: dict[int, float] = {}
    for step in range(rounds + 1):
        last = step == rounds
        todo = list(centres) if last else moving
        if not todo:
            continue
        sums = _add_up(_part_sums(rows, {k: centres[k] for k in todo}, last), ["k", "c"]).collect()  # a row for each centre
        if last:
            cost = {k: sum(r["cost"] for r in sums if r["k"] == k) for k in centres}
            break
        for k in todo:
            new = centres[k].copy()
            for r in sums:
                if r["k"] == k and r["n"]:
                    new[r["c"]] = np.frombuffer(r["sums"]) / r["n"]
            if np.allclose(new, centres[k], rtol=0, atol=1e-12):
                moving = [m for m in moving if m != k]
            centres[k] = new
    return KMeansModels(centres, cost)


def _part_sums(rows: DataFrame, centres: dict[int, np.ndarray], costs_only: bool) -> DataFrame:
    """(k, c, part, n, cost, sums) of each task."""
    ks = list(centres)
    stacked = np.concatenate([centres[k] for k in ks]).T.copy() if ks else np.zeros((0, 0))
    squares, ends = (stacked * stacked).sum(axis=0), np.cumsum(ks).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n, cost = np.zeros(ends[-1], dtype=np.int64), np.zeros(ends[-1])
        sums = np.zeros((ends[-1], 0 if costs_only else len(stacked)))
        for batch in batches:
            offsets, index, weight = _sparse(batch)
            for low, high in _blocks(offsets):
                a, b = offsets[low], offsets[high]
                part = offsets[low : high + 1] - a
                row = np.repeat(np.arange(high - low), np.diff(part))
                for begin, (c, d) in zip([0, *ends], _nearest(part, index[a:b], weight[a:b], stacked, squares, ends), strict=False):
                    np.add.at(n, begin + c, 1)
                    np.add.at(cost, begin + c, d)
                    if not costs_only:
                        _add_at(sums, begin + c[row], index[a:b], weight[a:b])
        part = TaskContext.get().partitionId() % FAN
        k = np.repeat(ks, ks).astype(np.int32)
        c = np.concatenate([np.arange(x) for x in ks]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(np.full(len(k), part, dtype=np.int32)), pa.array(n), pa.array(cost), pa.array([s.tobytes() for s in sums], pa.binary())], names=["k", "c", "part", "n", "cost", "sums"])

    return rows.select("term_index", "weight").mapInArrow(run, "k int, c int, part int, n long, cost double, sums binary")


def choose_k(elbow_k: int | None, n: int) -> int:
    """C6 rule: the elbow K if > 1, else 5 when n >= 5, else 0 (skip)."""
    if elbow_k is not None and elbow_k > 1:
        return elbow_k
    return DEFAULT_K if n >= DEFAULT_K else 0


def kmeans_assign(rows: DataFrame, k: int, keys: Sequence[str], models: KMeansModels | None, out_col: str = "text_cluster") -> DataFrame:
    """The nearest centre for K of each document; null where K was not
    fitted (n >= k > 1 does not hold)."""
    if models is None or k not in models.centres:
        return rows.select(*keys, F.lit(None).cast("int").alias(out_col))
    centres = models.centres[k].T.copy()
    squares = (centres * centres).sum(axis=0)

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        batch = pa.RecordBatch.from_arrays(columns, names=["term_index", "weight"])
        offsets, index, weight = _sparse(batch)
        out = [np.zeros(0, dtype=np.int64)]
        for low, high in _blocks(offsets):
            a, b = offsets[low], offsets[high]
            out += [c for c, _ in _nearest(offsets[low : high + 1] - a, index[a:b], weight[a:b], centres, squares, [k])]
        return [pa.array(np.concatenate(out).astype(np.int32))]

    return _arrow_function(rows.select(*keys, "term_index", "weight"), ["term_index", "weight"], work, f"{out_col} int")


# Principal components ---------------------------------------------------------
#: Directions beyond those asked for, blocks of a cycle, cycles, and the part of
#: the largest eigenvalue that a direction may be off by.
SPARE, CYCLE, CYCLES, OFF = 8, 6, 12, 1e-11


def principal_axes(rows: DataFrame, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(axes, variances, mean, n): the k directions of largest variance of the
    centred sparse rows, each with its largest entry positive.

    A block of k + ``SPARE`` directions is multiplied by the covariance, whose
    products the partitions sum up, so no width x width matrix is formed; the
    blocks of a cycle together give the best directions for the next, until none
    is off by more than rounding."""
    rng = np.random.default_rng(42)
    n, total = 0, np.zeros(width)
    for r in _add_up(_row_sums(rows, width), ["k"]).collect():
        n, total = r["n"], np.frombuffer(r["sums"])
    if not n or not width:
        return np.zeros((width, 0)), np.zeros(0), total, n
    mean = total / n

    def covariance(block: np.ndarray) -> np.ndarray:
        found = _add_up(_products(rows, block), ["k"]).collect()[0]  # one packed block
        return np.frombuffer(found["sums"]).reshape(width, -1) / n - np.outer(mean, mean @ block)

    size = min(width, k + SPARE)
    start = np.linalg.qr(rng.standard_normal((width, size)))[0]
    for _ in range(CYCLES):
        basis, images, block = np.zeros((width, 0)), np.zeros((width, 0)), start
        for _ in range(CYCLE):
            block = block - basis @ (basis.T @ block)
            block = block - basis @ (basis.T @ block)
            block, scale = np.linalg.qr(block)
            block = block[:, np.abs(np.diag(scale)) > 1e-10][:, : width - basis.shape[1]]
            if not block.shape[1]:
                break
            image = covariance(block)
            basis, images = np.concatenate([basis, block], axis=1), np.concatenate([images, image], axis=1)
            block = image
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        top = np.argsort(values)[::-1][:size]
        values, turn = values[top], turn[:, top]
        start = basis @ turn
        off = np.linalg.norm(images @ turn - start * values, axis=0)[:k]
        if not len(off) or off.max() <= OFF * max(values[0], 1e-300) or basis.shape[1] >= width:
            break
    axes = start[:, :k]
    sign = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return axes * sign, np.maximum(values[:k], 0.0), mean, n


def _row_sums(rows: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width)
        for batch in batches:
            _, index, weight = _sparse(batch)
            n += batch.num_rows
            np.add.at(sums, index, weight)
        yield _packed(n, sums)

    return rows.select("term_index", "weight").mapInArrow(run, "k int, part int, n long, cost double, sums binary")


def _products(rows: DataFrame, block: np.ndarray) -> DataFrame:
    """Sums of x (x . block) over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(block.shape)
        for batch in batches:
            offsets, index, weight = _sparse(batch)
            for low, high in _blocks(offsets):
                a, b = offsets[low], offsets[high]
                part = offsets[low : high + 1] - a
                z = _times(part, index[a:b], weight[a:b], block)
                row = np.repeat(np.arange(high - low), np.diff(part))
                each = np.tile(np.arange(z.shape[1]), b - a)
                _add_at(sums, np.repeat(index[a:b], z.shape[1]), each, (weight[a:b, None] * z[row]).reshape(-1))
        yield _packed(0, sums)

    return rows.select("term_index", "weight").mapInArrow(run, "k int, part int, n long, cost double, sums binary")


def _packed(n: int, sums: np.ndarray) -> pa.RecordBatch:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() % FAN
    return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([0.0]), pa.array([sums.tobytes()], pa.binary())], names=["k", "part", "n", "cost", "sums"])


def project(rows: DataFrame, keep: Sequence[str], axes: np.ndarray, shift: np.ndarray, out_col: str) -> DataFrame:
    """Each row's coordinates along the axes, less ``shift``."""

    def work(columns: list[pa.Array]) -> list[pa.Array]:
        offsets, index, weight = _sparse(pa.RecordBatch.from_arrays(columns, names=["term_index", "weight"]))
        out = [np.zeros((0, axes.shape[1]))]
        for low, high in _blocks(offsets):
            a, b = offsets[low], offsets[high]
            out.append(_times(offsets[low : high + 1] - a, index[a:b], weight[a:b], axes) - shift[None, :])
        return [pa.array(np.concatenate(out).tolist(), pa.list_(pa.float64()))]

    return _arrow_function(rows.select(*keep, "term_index", "weight"), ["term_index", "weight"], work, f"{out_col} array<double>")


def pca_2d(rows: DataFrame, keys: Sequence[str], width: int, written: bool = False) -> DataFrame:
    """Centred projection to two dimensions, skipped below two rows. No row
    is densified to the vocabulary's width. ``written`` rows are a table already."""
    rows = rows if written else cut_lineage(rows)
    axes, _, mean, n = principal_axes(rows, width, 2)
    if n < 2:
        return rows.select(*keys, F.lit(None).cast("double").alias("pc1"), F.lit(None).cast("double").alias("pc2"))
    out = project(rows, keys, axes, mean @ axes, "__p")
    return out.select(*keys, F.get("__p", F.lit(0)).alias("pc1"), F.coalesce(F.get("__p", F.lit(1)), F.lit(0.0)).alias("pc2"))
