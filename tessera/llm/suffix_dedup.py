"""Suffix-array dedup by a depth-limited radix sort.

Suffixes matter only through their first ``DEPTH`` bytes (their window), and
they are ordered by most-significant-digit passes that each drop what is alone
in its group; the groups left at full depth are exactly the repeated windows.
The first two passes work on a sample of the suffixes, the last ones on every
suffix that the sample leaves.

Pass 1 takes the leading ``ANCHOR`` bytes of one suffix in each window: the one
where their hash is least, leftmost on ties. Neighbouring windows share it, so
one row stands for a run of them, about one for each 35 bytes. Runs whose
sampled suffix is alone hold no repeat. Runs that are equal as a whole are
repeats but for the first of them.

Pass 2 takes what is left, the first of each of several unequal runs of one
anchor, and samples a suffix in every ``BLOCK`` windows, at fixed distances from
the anchor: the one where the last window of the block starts, through the bytes
that all of its windows share. Blocks whose sampled suffix is alone drop out.

Passes 3 and 4 take every suffix of the other blocks and order it by its leading
``DIGIT`` bytes and by the next ones up to ``DEPTH``. The least (document, start)
of a group stays, by a partial aggregation; the others are repeats.

Tasks merge equal runs before they send them, so a passage that many documents
share is sent once for each task's buffer; an anchor that meets many contexts in
one buffer is spread over tasks by context. A sampled suffix that many blocks
share is counted in part sums and joined, which Spark may split; an equal window
is one row of a task's part result. The texts are sent once: the joins by
document read the same exchange."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage

U = np.uint64
DEPTH, ANCHOR, BLOCK, DIGIT = 100, 32, 16, 50
#: Bytes hashed at once (long texts in pieces of this many window starts), and
#: runs that a task holds to merge equal ones.
CHUNK, HELD = 1 << 20, 1 << 19
#: Contexts of one anchor in a buffer from which it is spread.
SPREAD = 64
#: Kinds of row in pass 1.
RUN, SHARED, BEACON, MARK = 0, 1, 2, 3


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


class Rolling:
    """Polynomial hashes (modulo 2^64, of random byte values) of substrings of
    one array of bytes."""

    def __init__(self, salt: int):
        rng = np.random.default_rng(salt)
        self.value = rng.integers(0, 1 << 64, 256, dtype=U)
        base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.base, self.inverse = U(base % (1 << 64)), U(pow(base, -1, 1 << 64))
        self.power = self.back = np.ones(0, dtype=U)

    def load(self, data: np.ndarray) -> Rolling:
        n = len(data)
        if n >= len(self.power):
            for name, step in (("power", self.base), ("back", self.inverse)):
                steps = np.full(n + 1, step, dtype=U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n + 1, dtype=U)
        np.cumsum(self.value[data] * self.power[:n], out=self.sums[1:])
        return self

    def each(self, length: int) -> np.ndarray:
        """The hash of every substring of that length."""
        n = max(0, len(self.sums) - length)
        return mixed((self.sums[length : length + n] - self.sums[:n]) * self.back[:n])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(U) * U(0x9E3779B97F4A7C15))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have < width <= len(x) + have - 1:
        step = min(have, width - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x if have == width else x[:0]


class Anchors:
    """Runs of windows by anchor, of the pieces of texts in one array."""

    def __init__(self):
        self.a, self.b = Rolling(11), Rolling(12)

    def runs(self, pieces: list[bytes], starts: list[int]) -> tuple[np.ndarray, ...]:
        """Of each run: piece, first window start (in the piece), offset of the
        anchor from it, windows, anchor hash and hash of all its bytes.
        ``starts``: window starts of each piece that count."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        begin = np.cumsum([0, *map(len, pieces)])[:-1]
        h = self.a.load(data).each(ANCHOR)
        place_bits = U(24)  # more than the bytes of any array; the same for all, so that ties fall alike
        keyed = (h >> place_bits << place_bits) | np.arange(len(h), dtype=U)
        anchor = (sliding_min(keyed, DEPTH - ANCHOR + 1) & ((U(1) << place_bits) - U(1))).astype(np.int64)
        n = np.array(starts, dtype=np.int64)
        piece = np.repeat(np.arange(len(pieces)), n)
        start = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        if not len(start):
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
        opens = np.ones(len(start), dtype=bool)
        opens[1:] = (anchor[start[1:]] != anchor[start[:-1]]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(opens)
        count = np.diff(np.append(first, len(start)))
        s, piece = start[first], piece[first]
        whole = self.b.load(data).of(s, s + count - 1 + DEPTH)
        return piece, s - begin[piece], anchor[s] - s, count, h[anchor[s]].view(np.int64), whole.view(np.int64)


def _spans(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans of a document merged."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    first = np.append(True, doc[1:] != doc[:-1]) if len(doc) else np.zeros(0, dtype=bool)
    # Runs come in the order of their ends too, so the one before reaches furthest.
    opens = np.flatnonzero(first | np.append(True, begin[1:] > end[:-1])[: len(doc)])
    return doc[opens], begin[opens], np.maximum.reduceat(end, opens) if len(doc) else end


def _pass_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, whole, doc, span, kind) of pass 1. The span of a run packs
    start, anchor offset and windows; a mark holds its end as ``whole``."""
    anchors, held, n_held = Anchors(), [], 0

    def out(key, whole, doc, span, kind):
        kinds = np.broadcast_to(np.asarray(kind, dtype=np.int8), len(key))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, whole, doc, span)] + [pa.array(kinds)], names=["key", "whole", "doc", "span", "kind"])

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal held, n_held
        if not held:
            return
        doc, span, key, whole = (np.concatenate(x) for x in zip(*held, strict=True))
        held, n_held = [], 0
        order = np.lexsort((span, doc, whole, key))
        doc, span, key, whole = doc[order], span[order], key[order], whole[order]
        new_key = np.append(True, key[1:] != key[:-1])
        new = new_key | np.append(True, whole[1:] != whole[:-1])
        later = ~new
        if later.any():
            s = span[later] >> 14
            d, b, e = _spans(doc[later], s, s + (span[later] & 127) + DEPTH)
            yield out(mixed(d.view(U) * U(31) + b.view(U)).view(np.int64), e, d, b, MARK)
        group = np.cumsum(new_key) - 1
        contexts = np.bincount(group, weights=new)[group]
        spread = new & (contexts >= SPREAD)
        plain = new & ~spread
        yield out(key[plain], whole[plain], doc[plain], span[plain], RUN)
        if spread.any():
            yield out(mixed(key[spread].view(U) ^ mixed(whole[spread].view(U))).view(np.int64), whole[spread], doc[spread], span[spread], SHARED)
            light = np.unique(key[spread])
            zero = np.zeros(len(light), dtype=np.int64)
            yield out(light, mixed(light.view(U)).view(np.int64), zero, zero, BEACON)

    def take(docs: list[int], offsets: list[int], pieces: list[bytes], starts: list[int]) -> None:
        nonlocal n_held
        piece, s, offset, count, key, whole = anchors.runs(pieces, starts)
        s = s + np.array(offsets, dtype=np.int64)[piece]
        held.append((np.array(docs, dtype=np.int64)[piece], s << 14 | offset << 7 | (count - 1), key, whole))
        n_held += len(s)

    for batch in batches:
        docs, offsets, pieces, starts, size = [], [], [], [], 0
        for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
            for at in range(0, max(0, len(raw) - DEPTH + 1), CHUNK):
                part = raw[at : at + CHUNK + DEPTH - 1]
                docs.append(d)
                offsets.append(at)
                pieces.append(part)
                starts.append(len(part) - DEPTH + 1)
                size += len(part)
                if size >= CHUNK:
                    take(docs, offsets, pieces, starts)
                    docs, offsets, pieces, starts, size = [], [], [], [], 0
                if n_held >= HELD:
                    yield from flush()
        if pieces:
            take(docs, offsets, pieces, starts)
    yield from flush()


class Pieces:
    """Starts in texts, gathered until the bytes around them make a full array;
    a long text comes in several pieces of ``CHUNK`` starts."""

    def __init__(self, reach: int):
        self.reach = reach

    def arrays(self, batch: pa.RecordBatch, wanted) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(bytes, place of each start in them, row, index of the start in
        ``wanted(row)``) for the rows of a batch, whose texts are column 1."""
        parts, places, rows, which, size = [], [], [], [], 0
        for row in range(batch.num_rows):
            raw = (batch.column(1)[row].as_py() or "").encode("utf-8", "surrogatepass")
            starts = wanted(row)
            piece = starts // CHUNK
            for c in np.unique(piece).tolist():
                here = np.flatnonzero(piece == c)
                part = raw[c * CHUNK : (c + 1) * CHUNK + self.reach]
                parts.append(part)
                places.append(starts[here] - c * CHUNK + size)
                rows.append(np.full(len(here), row))
                which.append(here)
                size += len(part)
                if size >= CHUNK:
                    yield np.frombuffer(b"".join(parts), dtype=np.uint8), *(np.concatenate(x) for x in (places, rows, which))
                    parts, places, rows, which, size = [], [], [], [], 0
        if places:
            yield np.frombuffer(b"".join(parts), dtype=np.uint8), *(np.concatenate(x) for x in (places, rows, which))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of windows of each document's unequal runs: the hash of the sampled
    suffix through the bytes that a block's windows share, where it begins, and
    how far before it the block's last and first window start."""
    common, rolling, pieces = DEPTH - BLOCK + 1, Rolling(13), Pieces(DEPTH)
    for batch in batches:
        doc, found = batch.column(0).to_numpy(), {}

        def blocks(row: int) -> np.ndarray:
            span = batch.column(2)[row].values.to_numpy()  # noqa: B023
            s, offset, last = span >> 14, span >> 7 & 127, span & 127
            out = []
            for j in range((DEPTH - ANCHOR) // BLOCK + 1):
                low, high = np.maximum(offset - last, BLOCK * j) - BLOCK * j, np.minimum(offset, BLOCK * j + BLOCK - 1) - BLOCK * j
                here = low <= high
                out.append(np.stack([(s + offset)[here] - BLOCK * j, low[here], high[here], np.full(here.sum(), j)]))
            found[row] = np.concatenate(out, axis=1)  # noqa: B023
            return found[row][0]  # noqa: B023

        for data, place, row, which in pieces.arrays(batch, blocks):
            core = rolling.load(data).of(place, place + common)
            opens = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            begin, low, high, j = np.concatenate([found[row[o]][:, w] for o, w in zip(opens, np.split(which, opens[1:]), strict=True)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(mixed(core ^ j.astype(U)).view(np.int64)), pa.array(doc[row]), pa.array(begin), pa.array(low.astype(np.int8)), pa.array(high.astype(np.int8))],
                names=["core", "doc", "begin", "low", "high"],
            )


def _starts(blocks: pa.StructArray) -> np.ndarray:
    """The windows of blocks (begin, low, high), in order."""
    begin, low, high = (blocks.field(k).to_numpy().astype(np.int64) for k in range(3))
    n = high - low + 1
    return np.sort(np.repeat(begin - high - np.cumsum(n) + n, n) + np.arange(n.sum()))


def _digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two digits of every suffix of each document's blocks."""
    first, second, pieces = Rolling(14), Rolling(15), Pieces(DEPTH)
    for batch in batches:
        doc, found = batch.column(0).to_numpy(), {}

        def starts(row: int) -> np.ndarray:
            found[row] = _starts(batch.column(2)[row].values)  # noqa: B023
            return found[row]  # noqa: B023

        for data, place, row, which in pieces.arrays(batch, starts):
            leading = first.load(data).of(place, place + DIGIT)
            rest = second.load(data).of(place + DIGIT, place + DEPTH)
            opens = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            begin = np.concatenate([found[row[o]][w] for o, w in zip(opens, np.split(which, opens[1:]), strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(leading.view(np.int64)), pa.array(rest.view(np.int64)), pa.array(doc[row]), pa.array(begin)], names=["digit", "rest", "doc", "begin"])


def ordered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) and (doc, doc_id): ``doc`` is a long that orders the rows by
    doc_id. That is doc_id itself where it is unique and never null (then there
    is no second frame); else a number from a sort by doc_id (null first) and
    text, written once."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").head(1):
        return docs.select(F.col("doc_id").alias("doc"), "text").filter("doc IS NOT NULL"), None
    laid = cut_lineage(docs.orderBy(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")).select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text"))
    return laid.select("doc", "text").filter("doc IS NOT NULL"), laid.select("doc", "doc_id")


def first_pass(docs: DataFrame) -> DataFrame:
    """(mark, doc, begin, end) of pass 1, written: repeats of whole runs, and
    the runs that are left (packed in ``begin``)."""
    rows = docs.select("doc", "text").mapInArrow(_pass_one, "key long, whole long, doc long, span long, kind byte")
    group = Window.partitionBy("key")
    in_order = group.orderBy("whole", "doc", "span")
    run = F.col("kind") <= SHARED
    found = rows.withColumns({
        "later": run & (F.lag("whole").over(in_order) == F.col("whole")),
        "shared": (F.col("kind") == SHARED) | (F.min("whole").over(group) != F.max("whole").over(group)),
    })
    mark = (F.col("kind") == MARK) | F.coalesce("later", F.lit(False))
    return cut_lineage(found.filter(mark | (run & F.col("shared"))).select(
        mark.alias("mark"), "doc", F.when(mark & run, F.shiftright("span", 14)).otherwise(F.col("span")).alias("begin"),
        F.when(run, F.shiftright("span", 14) + F.col("span").bitwiseAND(127) + DEPTH).otherwise(F.col("whole")).alias("end"),
    ))


def later_passes(docs: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the runs (doc, begin) that pass 1 leaves: the blocks that pass 2
    leaves, as (doc, blocks), and the starts that are first in their group at
    full depth, as (doc, begin)."""
    unequal = runs.groupBy("doc").agg(F.collect_list("begin").alias("spans"))
    blocks = docs.join(unequal, "doc").select("doc", "text", "spans").mapInArrow(_blocks, "core long, doc long, begin long, low byte, high byte")
    shared = blocks.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    left = blocks.join(shared, "core", "left_semi").groupBy("doc").agg(F.collect_list(F.struct("begin", "low", "high")).alias("blocks"))
    suffixes = docs.join(left, "doc").select("doc", "text", "blocks").mapInArrow(_digits, "digit long, rest long, doc long, begin long")
    first = suffixes.groupBy("digit", "rest").agg(F.min(F.struct("doc", "begin")).alias("first")).select("first.*")
    return left, first


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, counts, digests = [], [], [], []
        for t, spans, blocks, first in zip(*(batch.column(k) for k in range(1, 5)), strict=True):
            raw, digest, at, gone, n = (t.as_py() or "").encode("utf-8", "surrogatepass"), hashlib.sha256(), 0, 0, 0
            begin = end = np.zeros(0, dtype=np.int64)
            if spans.is_valid:
                begin, end = (spans.values.field(k).to_numpy() for k in (0, 1))
            if blocks.is_valid:
                starts = _starts(blocks.values)
                if first.is_valid:
                    starts = np.setdiff1d(starts, first.values.to_numpy(), assume_unique=True)
                begin, end = np.append(begin, starts), np.append(end, starts + DEPTH)
            if len(begin):
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], end[order]
                reach = np.maximum.accumulate(end)
                opens = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
                n = len(opens)
                for b, e in zip(begin[opens].tolist(), np.append(reach[opens[1:] - 1], reach[-1]).tolist(), strict=True):
                    digest.update(raw[at:b])
                    gone, at = gone + e - b, e
            digest.update(raw[at:])
            sizes.append(len(raw))
            removed.append(gone)
            counts.append(n)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())], names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    A byte goes if a window of DEPTH bytes covers it that also starts earlier:
    in a row of smaller doc_id (null is smallest; rows of equal doc_id are
    ordered by text, and of repeated rows one counts as earlier), or earlier in
    the same text. A null text counts as empty; texts shorter than a window stay
    whole, long ones are read whole, in pieces; further columns are ignored; an
    empty table gives an empty one. Digits are compared by 64-bit hashes each: a
    window by two independent ones."""
    docs, ids = ordered(docs)
    found = first_pass(docs)
    blocks, first = later_passes(docs, found.filter("not mark"))
    marks = found.filter("mark").groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    first = first.groupBy("doc").agg(F.collect_list("begin").alias("first"))
    joined = docs.join(marks, "doc", "left").join(blocks, "doc", "left").join(first, "doc", "left").select("doc", "text", "spans", "blocks", "first")
    kept = joined.mapInArrow(_kept, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    named = kept.withColumnRenamed("doc", "doc_id") if ids is None else kept.join(ids, "doc").drop("doc")
    return named.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
