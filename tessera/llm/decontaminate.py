"""Benchmark decontamination with an FM-index for each training shard.

``build_index`` cuts every document into pieces of ``PIECE`` words that overlap
by a window less one word, so that every window lies whole in a piece, and
collects the pieces of a task into shards of at most ``SHARD`` symbols (a word
is a symbol; a piece ends with a terminator of its own). A shard's suffixes are
sorted by tripling the compared depth; their order gives the Burrows-Wheeler
transform, which is kept as a wavelet tree in level order, and the positions of
every ``SAMPLE``-th word of a piece. The index is a table: a row for each shard.

``find`` takes the windows of the test items in blocks of bounded size and
searches them backwards in every shard: a step narrows the interval of suffixes
by two wavelet-tree ranks. Each occurrence walks to a sampled position by the
same ranks. Its words are merged into spans, first in the task, then for each
document."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import cut_lineage, temporary

WINDOW = 10
PIECE, SAMPLE = 243, 16
#: Symbols of a shard: three ranks of this size fit a 63-bit key.
SHARD = 1 << 21
#: Words of test items in a block, and in one row of items.
BLOCK, ITEM_RUN = 1 << 17, 1 << 12
#: Occurrences located at once.
LOCATED = 1 << 20
U = np.uint64

#: ASCII letters are lowered; all that is no digit, letter or higher byte separates.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Symbol 0 ends a piece; ends are least,
    in the order of their places, so no comparison goes beyond one."""
    n = len(symbols)
    ends = symbols == 0
    m = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, symbols.astype(np.int64) + (m - 1))

    def keys(at: np.ndarray, h: int) -> np.ndarray:
        return rank[at] << 42 | rank[np.minimum(at + h, n - 1)] << 21 | rank[np.minimum(at + 2 * h, n - 1)]

    order, slots, h = np.arange(n), np.arange(n), 1
    while len(slots):
        at = order[slots]
        key = keys(at, h)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        opens = np.append(True, key[1:] != key[:-1])
        rank[at] = slots[np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))]
        tied = ~opens | np.append(~opens[1:], False)
        slots, h = slots[tied], 3 * h
    return order


class Wavelet:
    """A wavelet tree in level order: level by level, the next lower bit of the
    symbols, which are stably parted by it for the level below."""

    def __init__(self, levels: list[np.ndarray], counts: np.ndarray, n: int):
        self.n, self.words, self.depth = n, levels, len(levels)
        self.sums = [np.concatenate([[0], np.cumsum(np.bitwise_count(w), dtype=np.int64)]) for w in levels]
        self.zeros = [n - int(s[-1]) for s in self.sums]
        # Where each symbol's block starts on the last level (by its bits reversed)
        # against where it starts among the sorted suffixes.
        symbol = np.arange(len(counts))
        turned = np.zeros_like(symbol)
        for b in range(self.depth):
            turned |= (symbol >> b & 1) << self.depth - 1 - b
        by = np.argsort(turned)
        start = np.zeros(len(counts), dtype=np.int64)
        start[by] = np.cumsum(counts[by]) - counts[by]
        self.first = np.cumsum(counts) - counts
        self.shift = self.first - start

    @staticmethod
    def levels(symbols: np.ndarray, depth: int) -> list[np.ndarray]:
        out = []
        for b in reversed(range(depth)):
            one = (symbols >> b & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            out.append(np.append(packed, np.zeros(-len(packed) % 8 + 8, dtype=np.uint8)).view(U))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        return out

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (U(1) << (at & 63).astype(U)) - U(1)
        return self.sums[level][word] + np.bitwise_count(self.words[level][word] & below)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of suffixes before ``at``, those that ``symbol`` precedes, as a place
        in the order: backward search and LF mapping alike."""
        place = at
        for level in range(self.depth):
            ones = self.ones(level, place)
            place = np.where(symbol >> self.depth - 1 - level & 1 == 1, self.zeros[level] + ones, place - ones)
        return place + self.shift[symbol]

    def back(self, at: np.ndarray) -> np.ndarray:
        """The place of the suffix that starts one symbol earlier."""
        place, symbol = at, np.zeros_like(at)
        for level in range(self.depth):
            one = (self.words[level][place >> 6] >> (place & 63).astype(U) & U(1)).astype(np.int64)
            ones = self.ones(level, place)
            place = np.where(one == 1, self.zeros[level] + ones, place - ones)
            symbol = symbol << 1 | one
        return place + self.shift[symbol]


_SHARD_TYPE = pa.struct([
    ("n", pa.int32()), ("vocabulary", pa.binary()), ("counts", pa.binary()), ("levels", pa.list_(pa.binary())),
    ("sampled", pa.binary()), ("samples", pa.binary()),
    ("piece_row", pa.binary()), ("piece_begin", pa.binary()), ("piece_at", pa.binary()),
])
_SHARD_SQL = "struct<n: int, vocabulary: binary, counts: binary, levels: array<binary>, sampled: binary, samples: binary, piece_row: binary, piece_begin: binary, piece_at: binary>"


class Shard:
    """Pieces that become one FM-index."""

    def __init__(self):
        self.ids: defaultdict = defaultdict()
        self.ids.default_factory = lambda: len(self.ids) + 1
        self.parts, self.row, self.begin, self.at, self.n = [], [], [], [], 0

    def room(self, length: int) -> bool:
        return self.n + length + 1 <= SHARD

    def add(self, row: int, begin: int, words: list[bytes]) -> None:
        part = np.zeros(len(words) + 1, dtype=np.int32)
        part[:-1] = np.fromiter(map(self.ids.__getitem__, words), dtype=np.int32, count=len(words))
        self.parts.append(part)
        self.row.append(row)
        self.begin.append(begin)
        self.at.append(self.n)
        self.n += len(part)

    def packed(self) -> dict:
        symbols, at = np.concatenate(self.parts), np.array(self.at, dtype=np.int64)
        order = suffix_order(symbols)
        inside = np.arange(self.n) - np.repeat(at, np.diff(np.append(at, self.n)))
        marked = (inside % SAMPLE == 0)[order]
        depth = max(1, int(len(self.ids)).bit_length())
        return {
            "n": self.n,
            "vocabulary": b" ".join(self.ids),
            "counts": np.bincount(symbols, minlength=len(self.ids) + 1).astype(np.int32).tobytes(),
            "levels": [w.tobytes() for w in Wavelet.levels(symbols[order - 1], depth)],
            "sampled": np.packbits(marked, bitorder="little").tobytes() + bytes(16 - -(-self.n // 8) % 8),
            "samples": order[marked].astype(np.int32).tobytes(),
            "piece_row": np.array(self.row, dtype=np.int64).tobytes(),
            "piece_begin": np.array(self.begin, dtype=np.int64).tobytes(),
            "piece_at": at.astype(np.int32).tobytes(),
        }


def build_index(docs: DataFrame) -> DataFrame:
    """A written table with a row (row, doc_id, n_words) for each row of
    ``docs`` and a row (shard) for each FM-index."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()), T.StructField("shard", T._parse_datatype_string(_SHARD_SQL))])
    stride = PIECE - WINDOW + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, arrow_id = Shard(), None

        def flushed() -> pa.RecordBatch:
            none = [pa.nulls(1, pa.int64()), pa.nulls(1, arrow_id), pa.nulls(1, pa.int64())]
            return pa.RecordBatch.from_arrays([*none, pa.array([shard.packed()], _SHARD_TYPE)], names=schema.names)

        for batch in batches:
            arrow_id = batch.column(1).type
            counts = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                words = words_of(text.as_py())
                counts.append(len(words))
                for begin in range(0, max(len(words) - WINDOW + 1, min(1, len(words))), stride):
                    piece = words[begin : begin + PIECE]
                    if not shard.room(len(piece)):
                        yield flushed()
                        shard = Shard()
                    shard.add(row, begin, piece)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.nulls(len(counts), _SHARD_TYPE)], names=schema.names)
        if shard.n:
            yield flushed()

    return cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, schema))


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item, words): the words of each item, blank-joined, in runs of bounded
    length that overlap by a window less one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, runs = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                for begin in range(0, max(len(words) - WINDOW + 1, min(1, len(words))), ITEM_RUN):
                    items.append(item)
                    runs.append(b" ".join(words[begin : begin + ITEM_RUN + WINDOW - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(runs, pa.binary())], names=["item", "words"])

    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").mapInArrow(run, "item string, words binary")


class Windows:
    """The different windows of one block of items."""

    def __init__(self, runs: list[tuple[str, bytes]]):
        owners: dict[tuple, set] = defaultdict(set)
        names = sorted({item for item, _ in runs})
        number = {item: k for k, item in enumerate(names)}
        for item, run in runs:
            words = run.split(b" ")
            for begin in range(max(1, len(words) - WINDOW + 1)):
                owners[tuple(words[begin : begin + WINDOW])].add(number[item])
        self.names = names
        self.vocabulary = {w: k for k, w in enumerate({w for window in owners for w in window})}
        self.length = np.array([len(w) for w in owners], dtype=np.int64)
        #: Words from the last to the first.
        self.words = np.full((len(owners), WINDOW), -1, dtype=np.int64)
        for k, window in enumerate(owners):
            self.words[k, : len(window)] = [self.vocabulary[w] for w in reversed(window)]
        self.owners = np.concatenate([np.fromiter(o, dtype=np.int64) for o in owners.values()])
        self.owner_ends = np.cumsum([len(o) for o in owners.values()])

    def in_shard(self, shard: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, position) of every occurrence in the shard, in chunks."""
        counts = np.frombuffer(shard["counts"], dtype=np.int32).astype(np.int64)
        here = np.full(len(self.vocabulary) + 1, -1, dtype=np.int64)
        for symbol, word in enumerate(shard["vocabulary"].split(b" "), 1):
            k = self.vocabulary.get(word)
            if k is not None:
                here[k] = symbol
        symbols = here[self.words]
        alive = np.flatnonzero(((symbols >= 0) | (self.words < 0)).all(axis=1))
        tree = Wavelet([np.frombuffer(b, dtype=U) for b in shard["levels"]], counts, shard["n"])
        low = tree.first[symbols[alive, 0]]
        high = low + counts[symbols[alive, 0]]
        found = []
        for step in range(1, WINDOW + 1):
            whole = self.length[alive] == step
            found.append((alive[whole], low[whole], high[whole]))
            alive, low, high = alive[~whole], low[~whole], high[~whole]
            if not len(alive):
                break
            c = symbols[alive, step]
            low, high = tree.step(c, low), tree.step(c, high)
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
        window, low, high = (np.concatenate(x) for x in zip(*found, strict=True))
        samples = np.frombuffer(shard["samples"], dtype=np.int32)
        marks = np.frombuffer(shard["sampled"], dtype=np.uint8)
        marks = marks[: len(marks) // 8 * 8].view(U)
        mark_sums = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])
        # An interval is at most a shard; several share a chunk.
        chunk = np.cumsum(high - low) // LOCATED
        for part in np.split(np.arange(len(window)), np.flatnonzero(np.diff(chunk)) + 1) if len(window) else []:
            size = high[part] - low[part]
            place = np.repeat(low[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
            yield np.repeat(window[part], size), self._positions(tree, marks, mark_sums, samples, place)

    @staticmethod
    def _positions(tree: Wavelet, marks, mark_sums, samples, place: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(place), dtype=np.int64), np.arange(len(place))
        for walked in range(SAMPLE):
            word, bit = place >> 6, (place & 63).astype(U)
            sampled = (marks[word] >> bit & U(1)).astype(bool)
            w, b = word[sampled], bit[sampled]
            out[open_[sampled]] = samples[mark_sums[w] + np.bitwise_count(marks[w] & ((U(1) << b) - U(1)))] + walked
            open_, place = open_[~sampled], place[~sampled]
            if not len(open_):
                break
            place = tree.back(place)
        return out


def _merged(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a row as one."""
    by = np.lexsort((begin, row))
    row, begin, end = row[by], begin[by], end[by]
    first = np.append(True, row[1:] != row[:-1])
    # Reach within a row: rows are set apart by more than any end.
    group = np.cumsum(first) - 1
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * far)
    opens = np.flatnonzero(first | np.append(True, (begin + group * far)[1:] > reach[:-1]))
    last = np.append(opens[1:], len(row)) - 1
    return row[opens], begin[opens], reach[last] - group[opens] * far


def _hits(windows: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = batch.column(0)[k].as_py()
                at = np.frombuffer(shard["piece_at"], dtype=np.int32)
                rows, begins = (np.frombuffer(shard[c], dtype=np.int64) for c in ("piece_row", "piece_begin"))
                spans, owned = [], []
                for window, position in windows.in_shard(shard):
                    piece = np.searchsorted(at, position, side="right") - 1
                    row, begin = rows[piece], begins[piece] + position - at[piece]
                    spans.append(np.stack(_merged(row, begin, begin + windows.length[window])) if len(row) else np.zeros((3, 0), dtype=np.int64))
                    row, window = np.unique(np.stack([row, window]), axis=1) if len(row) else (row, window)
                    size = windows.owner_ends[window] - np.append(0, windows.owner_ends)[window]
                    place = np.repeat(windows.owner_ends[window] - np.cumsum(size), size) + np.arange(size.sum())
                    owned.append(np.unique(np.stack([np.repeat(row, size), windows.owners[place]]), axis=1) if len(row) else np.zeros((2, 0), dtype=np.int64))
                if not spans or not sum(s.shape[1] for s in spans):
                    continue
                row, begin, end = _merged(*np.concatenate(spans, axis=1))
                owner_row, owner = np.unique(np.concatenate(owned, axis=1), axis=1)
                hit = np.unique(row)
                cut, own = np.searchsorted(row, hit), np.searchsorted(owner_row, hit)
                spans_of = pa.ListArray.from_arrays(pa.array(np.append(cut, len(row)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"]))
                items_of = pa.ListArray.from_arrays(pa.array(np.append(own, len(owner)).astype(np.int32)), pa.array(np.array(windows.names, dtype=object)[owner], pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(hit), spans_of, items_of], names=["row", "spans", "items"])

    return run


def find(index: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row, spans, items) of every row with a hit: spans of word numbers
    (begin, end), merged and in order, and the different items, as sorted
    strings. The items are read in blocks of about ``BLOCK`` words; each block
    is sent to every shard."""
    spark = index.sparkSession
    hits = []

    def search(runs: list[tuple[str, bytes]]) -> None:
        shards = index.filter("shard IS NOT NULL").select("shard")
        hits.append(cut_lineage(shards.mapInArrow(_hits(Windows(runs)), "row long, spans array<struct<begin: long, end: long>>, items array<string>")))

    runs, size = [], 0
    for r in item_words(benchmark).toLocalIterator():
        runs.append((r.item, bytes(r.words)))
        size += r.words.count(b" ") + 1
        if size >= BLOCK:
            search(runs)
            runs, size = [], 0
    if runs:
        search(runs)
    if not hits:
        return spark.createDataFrame([], "row long, spans array<struct<begin: long, end: long>>, items array<string>")
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    grouped = found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return grouped.mapInArrow(_joined, grouped.schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each row merged: pieces and blocks overlap."""
    for batch in batches:
        if batch.num_rows:
            spans = batch.column(1)
            number = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
            number, begin, end = _merged(number, *(spans.flatten().field(k).to_numpy() for k in (0, 1)))
            ends = np.searchsorted(number, np.arange(batch.num_rows + 1)).astype(np.int32)
            merged = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), merged, batch.column(2)], names=batch.schema.names)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, spans and items of every row of ``docs``.

    A window is ``WINDOW`` consecutive words of an item; an item of fewer words
    is one window. Spans are runs of words that lie in any occurrence, items
    those with an occurring window (as strings, sorted, each once; a null
    item_id is the empty string). A null or empty text has no words: no span, no
    item, and an item without words has no window. Repeated rows and ids each
    get their own row, repeated items count once; texts of any length are
    searched whole, in pieces. Further columns are ignored; an empty table on
    either side gives rows without hits, or none."""
    index = build_index(docs)
    rows = index.filter("shard IS NULL").select("row", "doc_id", "n_words")
    return rows.join(find(index, benchmark), "row", "left").select(
        "doc_id", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<begin: bigint, end: bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def remove_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their columns; the words of hits are cut from
    the text with the separators between them. Other texts stay as they are."""
    row, spans = temporary(docs, "row"), temporary(docs, "spans")
    docs = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    numbered = docs.select(F.col(row).alias("doc_id"), "text")
    index = build_index(numbered)
    named = index.filter("shard IS NULL").select(F.col("row").alias("found"), F.col("doc_id").alias(row))
    hit = find(index, benchmark).withColumnRenamed("row", "found").join(named, "found").select(row, F.col("spans").alias(spans))
    joined = docs.join(hit, row, "left")
    place = joined.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cuts in zip(batch.column(place), batch.column(batch.num_columns - 1), strict=True):
                text = text.as_py()
                texts.append(without(text, [(s["begin"], s["end"]) for s in cuts.as_py()]) if cuts.is_valid else text)
            columns = [*batch.columns]
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return joined.mapInArrow(run, joined.schema).select(*[c for c in joined.columns if c not in (row, spans)])


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, from the first byte of a span's
    first word to the last byte of its last one."""
    raw = text.encode("utf-8", "surrogatepass")
    plain = np.frombuffer(raw.translate(_LOWER), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], plain, [False]]).astype(np.int8)))
    out, at = [], 0
    for begin, end in spans:
        out.append(raw[at : edges[2 * begin]])
        at = edges[2 * end - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
