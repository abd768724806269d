"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code on ``BLOCKS`` x 23 of the 64 bits: the
perfect binary Golay code on each block, whose words cover all 2^23 within
distance 3. Within a block a fingerprint lies at distance d from a code word and
needs max(0, d - 3) flips to come within its covering radius; the cost of an
anchor is the sum over blocks. Two fingerprints at distance t can be joined by
t flips, so some anchor costs one of them at most t // 2 and the other at most
t - t // 2. Each fingerprint is therefore replicated to every anchor of cost up
to t - t // 2 (in a block: within covering radius plus that), and fingerprints
are compared anchor by anchor over all 64 bits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import one_row_each, same_row
from tessera.llm.common import cut_lineage, per_batch, sql_schema, temporary
from tessera.llm.components import components

#: The Golay code's generator polynomial; a fixed value.
GOLAY = 0b101011100011
LENGTH, RADIUS, BLOCKS = 23, 3, 2
#: Members of an anchor that one task compares; more are compared in tiles.
GROUP, TILE = 16_384, 8_192
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """The SimHash of a text's word shingles (no words: 0), unsigned."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    if n == 1:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    counts, left, digest = np.zeros(64, dtype=np.int64), n, xxhash.xxh64_intdigest
    while left:
        part = min(left, CHUNK)
        h = np.fromiter((digest(next(shingles), seed) for _ in range(part)), dtype="<u8", count=part)
        counts += np.unpackbits(h.view(np.uint8).reshape(part, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        left -= part
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` (null: empty) as a signed
    long in column ``out``."""
    place = docs.columns.index("text")

    def make():
        def work(batch):
            values = np.fromiter((fingerprint(t.as_py() or "", size, seed) for t in batch.column(place)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values.view(np.int64))], names=[*batch.schema.names, out])

        return work

    return per_batch(docs, make, sql_schema(docs, (out, "long")))


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, LENGTH - 13, -1):
        if word >> bit & 1:
            word ^= GOLAY << bit - 11
    return word


@lru_cache(maxsize=4)
def cover(spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(low and high half's share of a word's syndrome; by syndrome the begin
    of a list; the lists: what to XOR to reach a code word, and its cost), with
    all code words of a cost up to ``spare``."""
    low = np.array([_remainder(x) for x in range(1 << 12)], dtype=np.int64)
    high = np.array([_remainder(x << 12) for x in range(1 << 11)], dtype=np.int64)
    flips, cost = [], []
    for weight in range(RADIUS + spare + 1):
        for places in combinations(range(LENGTH), weight):
            flips.append(sum(1 << p for p in places))
            cost.append(max(0, weight - RADIUS))
    flips, cost = np.array(flips, dtype=np.int64), np.array(cost, dtype=np.int64)
    syndrome = low[flips & 0xFFF] ^ high[flips >> 12]
    order = np.lexsort((cost, syndrome))
    begin = np.searchsorted(syndrome[order], np.arange((1 << 11) + 1))
    return low, high, begin, flips[order], cost[order]


def anchors(fps: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into ``fps``, anchor, cost) of every replica of cost up to
    ``spare``."""
    low, high, begin, flips, cost = cover(spare)
    index, anchor, paid = np.arange(len(fps)), np.zeros(len(fps), dtype=np.int64), np.zeros(len(fps), dtype=np.int64)
    for block in range(BLOCKS):
        word = ((fps >> np.uint64(LENGTH * block)) & np.uint64((1 << LENGTH) - 1)).astype(np.int64)[index]
        syndrome = low[word & 0xFFF] ^ high[word >> 12]
        n = begin[syndrome + 1] - begin[syndrome]
        row = np.repeat(np.arange(len(index)), n)
        item = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + begin[syndrome][row]
        total = paid[row] + cost[item]
        keep = total <= spare
        row, item, paid = row[keep], item[keep], total[keep]
        index, anchor = index[row], (anchor[row] << 12) | ((word[row] ^ flips[item]) >> 11)
    return index, anchor, paid


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of links: (node, root)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    found = [(x, root(x)) for x in parent]
    return [x for x, r in found if x != r], [r for x, r in found if x != r]


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= most


def _large(members: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect what is linked in one large group: breadth first,
    each member compared with those not reached yet, in bounded blocks."""
    rest, a, b = members, [], []
    while len(rest):
        seed, frontier, rest = rest[0], rest[:1], rest[1:]
        while len(frontier) and len(rest):
            hit = np.zeros(len(rest), dtype=bool)
            step = max(1, (1 << 20) // len(rest))
            for k in range(0, len(frontier), step):
                hit |= _near(frontier[k : k + step, None], rest[None, :], most).any(axis=0)
            frontier, rest = rest[hit], rest[~hit]
            a.append(frontier)
            b.append(np.full(len(frontier), seed))
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def links(keys: np.ndarray, fps: np.ndarray, most: int) -> tuple[list[int], list[int]]:
    """A forest of the links within groups of equal (sorted) keys."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    found = [_large(np.unique(fps[s : s + n]), most) for s, n in zip(starts[sizes > 32], sizes[sizes > 32], strict=True)]
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= 32), sizes))
    step = 1
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        hit = at[_near(fps[at], fps[at + step], most)]
        found.append((fps[hit], fps[hit + step]))
        step += 1
    if not found:
        return [], []
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(np.stack([a, b]), axis=1)
    return _forest(pairs[0], pairs[1])


def _compare(rows: DataFrame, most: int, limit: int | None) -> DataFrame:
    """Rows (key, fp) to links (u, v), by key. Keys with more than ``limit``
    rows come back as rows (u: fp, v: key, over: true) instead."""
    dealt = rows.repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u, v, over: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(np.full(len(u), over))], names=["u", "v", "over"])

        keys, fps, large = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), None
        for batch in batches:
            new_keys, new = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if large is not None:  # the rest of a key that is too large
                n = int(np.searchsorted(new_keys, large, side="right"))
                if n:
                    yield out(new[:n], new_keys[:n], True)
                new_keys, new = new_keys[n:], new[n:]
                if not len(new):
                    continue
                large = None
            keys, fps = np.concatenate([keys, new_keys]), np.concatenate([fps, new])
            tail = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            done_keys, done = keys[:tail], fps[:tail]
            keys, fps = keys[tail:], fps[tail:]
            if limit is not None:
                if len(keys) > limit:
                    large = int(keys[0])
                    yield out(fps, keys, True)
                    keys, fps = keys[:0], fps[:0]
                _, back, n = np.unique(done_keys, return_inverse=True, return_counts=True)
                over = n[back] > limit
                if over.any():
                    yield out(done[over], done_keys[over], True)
                    done_keys, done = done_keys[~over], done[~over]
            yield out(*links(done_keys, done, most), False)
        yield out(*links(keys, fps, most), False)

    return dealt.mapInArrow(run, "u long, v long, over boolean")


def fingerprint_links(fps: DataFrame, most: int = 3, group: int = GROUP, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect what fingerprints within ``most`` bits
    connect. ``fps``: distinct fingerprints (fp). Anchors of more than
    ``group`` members are compared in tiles of about ``tile``."""
    spare = most - most // 2

    def make():
        def work(batch):
            for k in range(0, batch.num_rows, 2048):
                values = batch.column(0).slice(k, 2048).to_numpy()
                index, anchor, _ = anchors(values.view(np.uint64), spare)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(values[index])], names=["key", "fp"])

        return work

    found = cut_lineage(_compare(per_batch(fps.select("fp"), make, "key long, fp long"), most, group))
    near, over = found.filter("not over").select("u", "v"), found.filter("over")
    if not over.head(1):
        return near
    # Anchors with too many members: every pair of blocks of them is a tile.
    over = over.select(F.col("u").alias("fp"), F.col("v").alias("key"))
    n = over.groupBy("key").agg(F.ceil(F.count("*") / F.lit(tile)).alias("blocks"))
    tiles = over.join(n, "key").withColumn("mine", F.pmod(F.xxhash64("fp"), "blocks"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiles = tiles.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "fp")
    return near.unionByName(_compare(tiles, most, None).select("u", "v"))


def _components(found: DataFrame, first: Column, most: int) -> DataFrame:
    """fp and ``least``, the smallest ``first`` of its component, for every
    fingerprint of ``found``."""
    classes = cut_lineage(found.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(fingerprint_links(classes, most))
    classes = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # Written: both sides of the next join are plain shuffles, which Spark
    # splits where one component holds many fingerprints.
    least = cut_lineage(classes.groupBy("root").agg(F.min("first").alias("least")))
    return classes.join(least, "root").select("fp", "least")


def near_duplicates(docs: DataFrame, size: int = 3, most: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of ``docs``:
    the smallest doc_id that links of at most ``most`` differing bits reach.

    A null or empty text has fingerprint 0, linked like any other; a null
    doc_id is never smallest; repeated rows and equal texts share a component;
    texts of any length are read whole. Further columns are ignored; an empty
    table gives an empty one."""
    found = cut_lineage(fingerprints(docs.select("doc_id", "text"), size, seed).select("doc_id", "fp"))
    return found.join(_components(found, F.col("doc_id"), most).withColumnRenamed("least", "component_id"), "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, size: int = 3, most: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id, null ids being largest, and of these the smallest SHA-256 of the
    text. Rows that repeat both doc_id and text count as one, whatever else they
    hold; rows that share a doc_id alone, or have none, are told apart by their
    text."""
    found = cut_lineage(fingerprints(docs.select("doc_id", "text"), size, seed).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), "fp"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha")
    kept = _components(found, first, most).select(F.col("least.doc_id").alias("kept_id"), F.col("least.sha").alias("kept_sha"))
    return one_row_each(docs, same_row(kept, "kept_id", F.col("kept_sha")), kept)
