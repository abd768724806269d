import hashlib
import math
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import fingerprints, mixing, sharding
from tessera.llm.common import documents
from tessera.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# Sharding --------------------------------------------------------------------
def check_shards(got, rows):
    wanted = sorted((str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == wanted
    slots, of = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        of[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())  # the key decides


def test_shards(edge, none, rows):
    check_shards(sharding.shard_documents(edge, [1.0] * 8, buckets=4).collect(), rows)
    assert sharding.shard_documents(none, [1.0] * 8).count() == 0


def test_shard_query(spark, sf_dir):
    rows = [tuple(r) for r in documents(spark, sf_dir).collect()]
    got = QUERIES["op3_shard"](spark, sf_dir).collect()
    check_shards(got, rows)
    assert sorted(got) == sorted(QUERIES["op3_shard"](spark, sf_dir).collect())


def test_weights_and_growth(spark):
    keys = spark.range(20000)
    weights = [1.0, 2.0, 0.0, 5.0]
    n = {r[0]: r[1] for r in keys.groupBy(sharding.rendezvous(F.col("id"), weights).alias("s")).count().collect()}
    assert 2 not in n and all(abs(n[k] / 20000 - w / 8) < 0.02 for k, w in enumerate(weights) if w)
    moved = keys.select(sharding.rendezvous(F.col("id"), [1.0] * 8).alias("a"), sharding.rendezvous(F.col("id"), [1.0] * 9).alias("b")).filter("a <> b")
    assert moved.filter("b <> 8").count() == 0 and abs(moved.count() / 20000 - 1 / 9) < 0.01
    for bad in ([], [0.0], [1.0, -1.0]):
        with pytest.raises(ValueError):
            sharding.rendezvous(F.col("id"), bad)


# Mixing --------------------------------------------------------------------------
def test_targets_by_hand():
    assert mixing.targets([100, 100, 100], [3, 1, 2], 450, 2) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert mixing.targets([10, 100, 100], [3, 1, 2], 315, 2) == [20.0, pytest.approx(295 / 3), pytest.approx(590 / 3)]
    assert mixing.targets([0, 10], [3, 1], 15, 2) == [0.0, 15.0]
    assert mixing.targets([], [], 0, 2) == []


def test_splitting_tree():
    quotas = [1000, 1, 0, 37, 12345]
    for shards in (1, 2, 7, 64):
        got = mixing.split_quotas(quotas, shards, 3)
        assert got.sum(axis=1).tolist() == quotas and (got >= 0).all()
        assert np.ptp(got.sum(axis=0)) <= np.ceil(np.log2(shards)) + 1
        assert (got == mixing.split_quotas(quotas, shards, 3)).all()
    # The shares of a large source are close to even, as without replacement.
    assert np.abs(mixing.split_quotas([80000, 40000], 8, 1)[0] - 10000).max() < 500


def check_mix(planned, rows, sources):
    got = planned.collect()
    assert sorted((str(r.doc_id), str(r.source), r["size"]) for r in got) == sorted((str(r[0]), str(r[3]), len(WORDS.findall(r[1] or ""))) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORDS.findall(r[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s))
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))], 1.5 * sum(sizes.values()), 2), strict=True))
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == sum(d["words"] for d in r.draws)
        assert [d["pass"] for d in r.draws] == list(range(len(r.draws))) and all(0 <= d["shard"] < 64 for d in r.draws)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= 0.5 for s in order)


def test_mix(edge, none, rows):
    check_mix(mixing.plan_mix(edge, block=3), rows, None)
    assert mixing.plan_mix(none).count() == 0 and mixing.mix(none).count() == 0


def test_mix_query_and_reruns(spark, sf_dir):
    rows = [tuple(r) for r in documents(spark, sf_dir).collect()]
    check_mix(QUERIES["op1_mix"](spark, sf_dir), rows, 20)
    assert sorted(QUERIES["op1_mix"](spark, sf_dir).collect()) == sorted(mixing.plan_mix(documents(spark, sf_dir).repartition(3)).collect())


def test_mixed_rows(spark, sf_dir):
    docs = documents(spark, sf_dir)
    planned = {r.doc_id: r for r in mixing.plan_mix(docs).collect()}
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    rows, whole = defaultdict(list), {r.doc_id: r.text for r in docs.collect()}
    for r in got.collect():
        rows[r.doc_id].append(len(WORDS.findall(r.text)))
        assert r.text == whole[r.doc_id] or WORDS.findall(r.text) == WORDS.findall(whole[r.doc_id])[: len(WORDS.findall(r.text))]
        assert r.n_chars == len(r.text)
    assert {k: sorted(v) for k, v in rows.items()} == {k: sorted(d["words"] for d in r.draws) for k, r in planned.items() if r.draws}


def test_mixed_words_meet_the_plan_whatever_the_ids(spark):
    """Null ids, an id on a third of the rows, and repeated rows get draws of
    their own: every source has as many words as the plan takes."""
    rng = random.Random(2)
    text = lambda: " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 4)))
    for ids in (lambda k: None, lambda k: k if k % 2 else None, lambda k: 7 if k % 3 == 0 else k):
        rows = [(ids(k), text(), "abc"[k % 3] if k % 3 < 2 or k % 5 else "b") for k in range(900)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
        planned = defaultdict(int)
        for r in mixing.plan_mix(docs, block=20).collect():
            planned[r.source] += r.taken
        mixed = defaultdict(int)
        for r in mixing.mix(docs, block=20).collect():
            mixed[r.source] += len(WORDS.findall(r.text))
        assert mixed == planned
        # No block is made of one id alone.
        check_mix(mixing.plan_mix(docs, block=20), [(i, t, None, s) for i, t, s in rows], None)


def test_mixed_rows_keep_their_white_space(spark):
    rows = [(k, f"\t one{k}\n\n two  three\r\nfour\t\tfive \n", f"s{k % 8}") for k in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    whole = {k: t for k, t, _ in rows}
    cut = [r for r in got if r.text != whole[r.doc_id]]
    assert cut and all(whole[r.doc_id].startswith(r.text) and not r.text[-1].isspace() for r in cut)


def plain_shard(key, n):
    """Least -ln(u) over the shards, by the same hashes of key and shard."""
    first = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)

    def score(shard):
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), first)
        return (-math.log(((h >> 11) + 1) / 2**53), shard)

    return min(map(score, range(n)))[1]


def test_every_row_goes_to_the_best_shard(spark, sf_dir, edge, rows):
    for docs in (edge, documents(spark, sf_dir)):
        for r in sharding.shard_documents(docs, [1.0] * 8).collect():
            assert (r.shard, r.grown_shard) == (plain_shard(r.doc_id, 8), plain_shard(r.doc_id, 9))


# Fingerprints -----------------------------------------------------------------------
def paragraphs(text):
    return set(re.findall(r"[^\n]{1,256}", text))


def like(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return 1.0 if not a and not b else (len(a) + len(b) - len(a ^ b)) / (len(a) + len(b))


def check_fingerprints(got, order):
    """``order``: (doc_id, text) in descending order."""
    texts = [t or "" for _, t in order]
    prints = {}
    wanted = []
    for k, t in enumerate(texts):
        after = texts[(k + 1) % len(texts)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        wanted.append((str(order[k][0]), len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(t, edited), 9), round(like(t, after), 9)))
        prints[edited] = prints[t] = None
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == sorted(wanted)
    sets = {frozenset(paragraphs(t)) for t in texts}
    assert len({r.fingerprint for r in got}) == len(sets)  # equal for equal texts, and only for equal sets


def test_fingerprint_query(spark, sf_dir):
    order = sorted(((r.doc_id, r.text) for r in documents(spark, sf_dir).collect()), reverse=True)
    check_fingerprints(QUERIES["op7_fingerprints"](spark, sf_dir).collect(), order)


def test_fingerprints_of_many_and_long_lines(spark):
    texts = ["", None, "a", "x" * 3000, "y" * 100_000, "\n".join(f"line {k}" for k in range(3000)), "\n".join(f"line {k}" for k in range(0, 6000, 2)), "\n" * 50, "🙂" * 500, "one", "one"]
    rows = [(k * 10, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for ranges in (1, 3, 40):
        check_fingerprints(fingerprints.fingerprint_documents(df, ranges).collect(), rows[::-1])


def test_fingerprint_edges(spark, edge, none, rows):
    got = fingerprints.fingerprint_documents(edge).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(r[0]), len(r[1] or "")) for r in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprints.fingerprint_documents(none).count() == 0
    single = fingerprints.fingerprint_documents(spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")).collect()
    assert single[0].near_next == 1.0


def test_retries_with_larger_tables(spark):
    """Tables far beyond their load peel after doubling, or are counted."""
    df = spark.range(20).select(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.xxhash64("id", i)).alias("a"), F.transform(F.sequence(F.lit(31), F.lit(100)), lambda i: F.xxhash64("id", i)).alias("b"))
    k = F.lit(0)
    n = fingerprints.differing(F.col("a"), F.col("b"), fingerprints.sketch(F.col("a"), k), fingerprints.sketch(F.col("b"), k), k)
    for a, b, found in df.select("a", "b", n).collect():
        assert sorted((d.n, d.key) for d in found) == sorted([(1, d) for d in a[:30]] + [(-1, d) for d in b[30:]])


def test_digests_of_an_edit(spark):
    """What peeling recovers is what differs, also in tables of many digests."""
    rows = [(2, "\n".join(f"line {k}" for k in range(900))), (1, "\n".join(f"other {k}" for k in range(900)))]
    (got,) = [r for r in fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id == 2]
    half = len(rows[0][1]) // 2
    before, after = paragraphs(rows[0][1]), paragraphs(rows[0][1][: len(rows[0][1]) - half] + rows[1][1][:half])
    hashed = lambda texts: sorted(struct.unpack("<q", struct.pack("<Q", xxhash.xxh64(t.encode(), seed=42).intdigest()))[0] for t in texts)
    assert (sorted(got.removed_digests), sorted(got.added_digests)) == (hashed(before - after), hashed(after - before))


def test_ranges_of_null_and_repeated_ids(spark):
    """Half of all ids null, a third one id: no range holds many of either, and
    every row still meets the row behind it."""
    rows = [(None if k % 2 else 7 if k % 3 == 0 else k, f"text {k}\nsecond {k % 5}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = fingerprints.with_next(df, 12).filter("not ghost").groupBy("range").count().collect()
    assert sum(r["count"] for r in placed) == 600 and max(r["count"] for r in placed) < 120
    signed = lambda t: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64(t.encode(), seed=42).intdigest()))[0]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1])))
    check_fingerprints(fingerprints.fingerprint_documents(df, 12).collect(), order)
