"""Token counts by rank-synchronous array merging.

A batch of new pre-tokens is one ragged numpy array of symbols. In each round
every sequence merges all occurrences of its own lowest-rank pair at once;
what survives is counted. A merge only makes pairs of higher rank (checked when
the vocabulary is read), so merging all occurrences at once gives what merging
one by one gives. Narrow: one pass over the texts, no shuffle."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.common import per_batch, sql_schema
from tessera.llm.pretokens import Memo, Splitter

#: Split of a byte-level pre-tokenizer; fixed value of that format.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Symbols that are merged together in one array.
SYMBOLS = 1 << 20
#: Characters of texts whose new pre-tokens are merged together.
TOGETHER = 1 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in such files:
    visible Latin-1 characters stand for themselves, the others are counted
    on from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class MergeTable:
    """Pairs of symbol ids with their rank and the id they merge into."""

    def __init__(self, vocab: dict[str, int], merges: list, special: list[str]):
        self.size = max(vocab.values()) + 1
        self.first = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        rank_of = np.full(self.size, -1, dtype=np.int64)
        rank_of[made] = np.arange(len(pairs))
        if (np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(pairs))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        key = left * self.size + right
        self._hash(key, made)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.split = Splitter(BYTE_LEVEL)
        self.memo = Memo(self.lengths)

    def _hash(self, key: np.ndarray, made: np.ndarray) -> None:
        """An open-addressing table of the pairs, at most an eighth full."""
        self.none = len(key)
        bits = max(4, int(8 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, dtype=np.int64)
        self.rank, self.made = np.full(1 << bits, self.none, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        todo, slot = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.key[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            put = todo[free][first]
            self.key[at], self.rank[at], self.made[at] = key[put], put, made[put]
            left = self.key[slot] != key[todo]
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The slot of each pair, or an empty slot."""
        slot = self._slot(key)
        there = self.key[slot]
        todo = np.flatnonzero((there != key) & (there >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            there = self.key[slot[todo]]
            todo = todo[(there != key[todo]) & (there >= 0)]
        return slot

    def lengths(self, pieces: list[str]) -> list[int]:
        """Symbols that survive in each pre-token."""
        out: list[int] = []
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        at = 0
        while at < len(raw):
            stop, total = at, 0
            while stop < len(raw) and (stop == at or total + len(raw[stop]) <= SYMBOLS):
                total += len(raw[stop])
                stop += 1
            out += self._merged(raw[at:stop]).tolist()
            at = stop
        return out

    def _merged(self, raw: list[bytes]) -> np.ndarray:
        n = np.array([len(r) for r in raw], dtype=np.int64)
        flat = self.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(raw)), n)  # whose symbol it is
        none = self.none
        while len(flat) > 1 and none:
            key = flat[:-1] * self.size + flat[1:]
            place = self._find(key)
            rank = np.append(np.where(seq[:-1] == seq[1:], self.rank[place], none), none)
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(flat)))
            lowest = np.repeat(least, sizes)
            hit = (rank == lowest) & (rank < none)
            # "aaa" holds the pair twice, overlapping: take every other, from the left.
            index = np.arange(len(flat))
            opens = hit & ~np.append(False, hit[:-1])
            run = np.maximum.accumulate(np.where(opens, index, 0))
            hit &= (index - run) % 2 == 0
            where = np.flatnonzero(hit)
            flat[where] = self.made[place[where]]
            keep = np.ones(len(flat), dtype=bool)
            keep[where + 1] = False
            gone = np.bincount(seq[~keep], minlength=len(raw))
            n -= gone
            keep &= lowest < none  # a sequence without a pair left has ended
            flat, seq = flat[keep], seq[keep]
        return n

    def parts(self, text: str) -> list[str]:
        """The text between special strings, each of which is one token."""
        return self.special.split(text) if self.special else [text]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text. The new pre-tokens of all are merged together;
        a long text is taken in runs."""
        if len(texts) == 1:
            parts = self.parts(texts[0])
            total = len(parts) - 1
            for part in parts:
                for pieces in self.split.lists(part):
                    self.memo.learn([pieces])
                    total += sum(self.memo.results(pieces))
            return [total]
        split = [[pieces for part in self.parts(t) for pieces in self.split.lists(part)] for t in texts]
        self.memo.learn([pieces for lists in split for pieces in lists])
        return [len(lists) - 1 + sum(sum(self.memo.results(p)) for p in lists) for lists in split]


def read_merges(path: str) -> tuple[str, str]:
    """The parts of a tokenizer file that matter, as JSON texts (vocabulary
    and merges, special strings). Other kinds of file are refused."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, pre = whole["model"], whole.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or whole.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    added = whole.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that strip or need word ends are not supported")
    return json.dumps([model["vocab"], model["merges"]]), json.dumps([t["content"] for t in added])


@lru_cache(maxsize=2)
def _table(model: str, special: str) -> MergeTable:
    vocab, merges = json.loads(model)
    return MergeTable(vocab, merges, json.loads(special))


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens)
    of every document.

    A null or empty text has 0 bytes and 0 tokens. Each row is counted by
    itself: repeated rows stay, null ids stay null, an empty table gives an
    empty one and further columns are ignored."""
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(read_merges(path))

    def make():
        table = _table(*shared.value)

        def work(batch):
            sizes, counts, held, chars = [], [], [], 0
            for t in batch.column(1):
                text = t.as_py() or ""
                sizes.append(len(text.encode("utf-8", "surrogatepass")))
                if held and chars + len(text) > TOGETHER:
                    counts += table.counts(held)
                    held, chars = [], 0
                held.append(text)
                chars += len(text)
            counts += table.counts(held) if held else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

        return work

    return per_batch(docs, make, sql_schema(docs.select("doc_id"), ("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")))
