"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash over the vocabulary resolves pre-tokens that
are themselves tokens; the others are merged with a heap of candidate pairs
over a linked list of bytes. Narrow: one pass over the texts, no shuffle. The
vocabulary (its size is fixed by its file) is broadcast once."""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tessera.llm.common import per_batch, sql_schema
from tessera.llm.pretokens import Memo, Splitter

U = np.uint64


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots, no empty slot.

    Keys fall into buckets by one half of their hash; each bucket gets, largest
    first, the smallest displacement that sends its keys to free slots. Buckets
    of one key store their slot itself. A look-up compares the stored key."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 4)
        h = self.hashes(keys)
        if len(np.unique(h)) < n:
            raise ValueError("vocabulary repeats a token")
        bucket = self._bucket(h)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(counts)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        self.keys: list[bytes] = [b""] * n
        self.values = np.zeros(n, dtype=np.int64)
        used = np.zeros(n, dtype=bool)
        for b in np.argsort(-counts, kind="stable"):
            if counts[b] < 2:
                break
            mine, base = order[ends[b] - counts[b] : ends[b]], 0
            while True:
                slots = self._slot(h[mine][None, :], np.arange(base, base + 256, dtype=U)[:, None])
                free = ~used[slots].any(axis=1)
                for row in np.flatnonzero(free):
                    if len(set(slots[row].tolist())) == len(mine):
                        break
                else:
                    base += 256
                    continue
                break
            self.shift[b] = base + row
            self._put(slots[row], mine, keys, used)
        left = iter(np.flatnonzero(~used))
        for b in np.flatnonzero(counts == 1):
            slot = int(next(left))
            self.shift[b] = -1 - slot
            self._put([slot], order[ends[b] - 1 : ends[b]], keys, used)

    def _put(self, slots, mine, keys, used):
        for slot, k in zip(slots, mine, strict=True):
            used[slot], self.keys[slot], self.values[slot] = True, keys[k], k

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=U, count=len(keys))

    def _bucket(self, h):
        return ((h >> U(33)) % U(self.buckets)).astype(np.int64)

    def _slot(self, h, d):
        with np.errstate(over="ignore"):
            z = (h ^ (d * U(0x9E3779B97F4A7C15))) * U(0xBF58476D1CE4E5B9)
        return ((z ^ (z >> U(31))) % U(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The index of each key in the list given at first, or -1."""
        if not keys or not self.n:
            return [-1] * len(keys)
        h = self.hashes(keys)
        d = self.shift[self._bucket(h)]
        slots = np.where(d < 0, -1 - d, self._slot(h, np.maximum(d, 0).astype(U)))
        own, values = self.keys, self.values[slots].tolist()
        return [v if own[s] == k else -1 for k, s, v in zip(keys, slots.tolist(), values, strict=True)]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, leftmost first, until none is
    in the vocabulary. A heap entry is rank * length + first byte of the pair's
    left part; ``rank`` holds what is current, so older entries are skipped."""
    n, none, get = len(piece), 1 << 62, ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = [get(piece[i : i + 2], none) for i in range(n - 1)]
    rank.append(none)
    heap = [r * n + i for i, r in enumerate(rank) if r < none]
    heapify(heap)
    while heap:
        r, i = divmod(heappop(heap), n)
        if rank[i] != r:
            continue
        mid = after[i]
        after[i] = stop = after[mid]
        rank[mid], rank[i] = -1, none
        if stop < n:
            before[stop] = i
            rank[i] = r = get(piece[i : after[stop]], none)
            if r < none:
                heappush(heap, r * n + i)
        p = before[i]
        if p >= 0:
            rank[p] = r = get(piece[p:stop], none)
            if r < none:
                heappush(heap, r * n + p)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], ids: list[int], pattern: str):
        self.split = Splitter(pattern)
        self.index = PerfectHash(tokens)
        self.ids = np.asarray(ids, dtype=np.int64)
        self.ranks = dict(zip(tokens, ids, strict=True))
        self.bytes_of = dict(zip(ids, tokens, strict=True))
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
        self.memo = Memo(self._resolve)

    def _resolve(self, pieces: list[str]) -> list[bytes]:
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        whole = self.index.find(raw)
        ids = ((self.ids[k],) if k >= 0 else merge_bytes(r, self.ranks) for r, k in zip(raw, whole, strict=True))
        return [struct.pack(f"<{len(x)}I", *x) for x in ids]

    def encode(self, text: str) -> list[bytes]:
        """The ids as little-endian unsigned 32-bit integers, in chunks."""
        out = []
        for pieces in self.split.lists(text):
            self.memo.learn([pieces])
            out.append(b"".join(self.memo.results(pieces)))
        return out

    def decode(self, chunk: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(chunk, dtype="<u4").tolist()))


def read_ranks(path: str) -> tuple[list[bytes], list[int]]:
    """A rank file: a line holds a token in base 64 and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return [base64.b64decode(t) for t, _ in pairs], [int(r) for _, r in pairs]


@lru_cache(maxsize=2)
def _codec(tokens: tuple[bytes, ...], ids: tuple[int, ...], pattern: str) -> ByteBpe:
    return ByteBpe(list(tokens), list(ids), pattern)


def _codec_factory(df: DataFrame, path: str, pattern: str):
    tokens, ids = read_ranks(path)
    shared = df.sparkSession.sparkContext.broadcast((tuple(tokens), tuple(ids), pattern))
    return lambda: _codec(*shared.value)


def encoded_documents(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with columns ``ids`` (array<int>), ``n_tokens``, ``ids_sha256``
    (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (of the bytes that the ids decode to). They replace
    columns of those names.

    A null or empty text has no ids. Rows are neither merged nor moved, so
    repeated rows and ids, ties and other columns need no rule; an empty table
    gives an empty one."""
    docs = docs.drop("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    codec_of, place = _codec_factory(docs, path, pattern), docs.columns.index(text)

    def make():
        codec = codec_of()

        def work(batch):
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                raw = [b"".join(codec.encode(t.as_py() or "")) for t in part.column(place)]
                rows = [np.frombuffer(r, dtype="<i4") for r in raw]
                ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))
                more = [ids, pa.array([len(r) for r in rows], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()), pa.array([hashlib.sha256(codec.decode(r)).hexdigest() for r in raw], pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

        return work

    return per_batch(docs, make, sql_schema(docs, ("ids", "array<int>"), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")))


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for (null ids: none), in
    column ``out``. An id outside the vocabulary fails."""
    encoded = encoded.drop(out)
    codec_of, place = _codec_factory(encoded, path, pattern), encoded.columns.index(ids)

    def make():
        codec = codec_of()

        def work(batch):
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                raw = [codec.decode(np.asarray(x.as_py() or [], dtype="<u4").tobytes()) for x in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, out])

        return work

    return per_batch(encoded, make, sql_schema(encoded, (out, "binary")))


def bpe_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """For each document the count and SHA-256 of its ids, and the SHA-256 of
    the bytes they decode to. Ids and bytes stay in the task, in chunks.

    A null or empty text has no ids. Each row is taken by itself: repeated rows
    and null ids stay, other columns are ignored, an empty table gives an empty
    one."""
    docs = docs.select("doc_id", "text")
    codec_of = _codec_factory(docs, path, pattern)

    def make():
        codec = codec_of()

        def work(batch):
            n, ids, back = [], [], []
            for t in batch.column(1):
                count, a, b = 0, hashlib.sha256(), hashlib.sha256()
                for chunk in codec.encode(t.as_py() or ""):
                    count += len(chunk) // 4
                    a.update(chunk)
                    b.update(codec.decode(chunk))
                n.append(count)
                ids.append(a.hexdigest())
                back.append(b.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return work

    schema = sql_schema(docs.select("doc_id"), ("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string"))
    return per_batch(docs, make, schema)
