import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tessera.llm import exact_dedup, simhash, suffix_dedup
from tessera.llm.common import cut_lineage, documents
from tessera.llm.components import components
from tessera.llm.queries import ORACLES, QUERIES


# Exact dedup ---------------------------------------------------------------
def key(doc_id):
    return (doc_id is not None, doc_id or 0)


@pytest.mark.parametrize("keep", ["max", "min"])
def test_copy_groups(edge, none, rows, keep):
    got = exact_dedup.copy_groups(edge, keep, rounds=2, bits=2).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    best = {t: (max if keep == "max" else min)(ids, key=key) for t, ids in groups.items()}
    wanted = sorted((str(r[0]), str(best[r[1] or ""]), len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == wanted
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert len(kept) == len(groups)  # one row each, of repeated rows too
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.copy_groups(none, keep).count() == 0


def test_drop_copies(edge, none, rows):
    got = exact_dedup.drop_copies(edge)
    assert got.columns == edge.columns
    best = {}
    for r in rows:
        best[r[1] or ""] = max(best.get(r[1] or "", (False, 0)), key(r[0]))
    assert sorted(((key(r.doc_id)), r.text or "") for r in got.collect()) == sorted((k, t) for t, k in best.items())
    assert exact_dedup.drop_copies(none).count() == 0


def test_tree_gives_the_same_for_any_shape(spark, sf_dir):
    docs = documents(spark, sf_dir)
    one = exact_dedup.copy_groups(docs, rounds=1, bits=3)
    three = exact_dedup.copy_groups(docs, rounds=3, bits=1)
    assert sorted(one.collect()) == sorted(three.collect())


def test_exact_dedup_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = QUERIES["op8_exact_dedup"](spark, sf_dir)
    wanted = con.execute(ORACLES["op8_exact_dedup"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(wanted)


# SimHash -------------------------------------------------------------------
def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps: dict, most: int = 3) -> dict:
    nodes, root = list(fps), {n: n for n in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= most:
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_near_duplicates(edge, none, rows):
    fps = {k: plain_fingerprint(r[1]) for k, r in enumerate(rows)}
    root = plain_components(fps)
    least = {c: min((rows[k][0] for k in fps if root[k] == c and rows[k][0] is not None), default=None) for c in root.values()}
    got = simhash.near_duplicates(edge).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == sorted((str(r[0]), fps[k], str(least[root[k]])) for k, r in enumerate(rows))
    kept = simhash.drop_near_copies(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least[c]) for c in set(root.values()))
    assert simhash.near_duplicates(none).count() == 0 and simhash.drop_near_copies(none).count() == 0


def test_near_copies_replace_only_each_other(spark):
    noise = lambda k: " ".join(random.Random(k).choices([f"w{i}" for i in range(500)], k=80))
    rows = [(k if k % 3 else None, noise(k)) for k in range(60)]  # a third without an id
    rows += [(7, noise(100)), (7, noise(101))]  # other texts under an id that is taken
    rows += [(None, noise(1)), (200, noise(0)), (None, noise(3)), (7, noise(101)), (None, None), (None, "")]  # copies
    root = plain_components({k: plain_fingerprint(t) for k, (_, t) in enumerate(rows)})
    groups = defaultdict(list)
    for k, (doc_id, text) in enumerate(rows):
        groups[root[k]].append((doc_id is None, doc_id or 0, hashlib.sha256((text or "").encode()).hexdigest()))
    assert len(groups) == 63
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id is None, r.doc_id or 0, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(got) == sorted(min(g) for g in groups.values())


def test_simhash_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    fps = {k: plain_fingerprint(t) for k, t in docs.items()}
    root = plain_components(fps)
    least = {c: min(k for k in fps if root[k] == c) for c in root.values()}
    got = QUERIES["op6_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (format(f, "016x"), least[root[k]]) for k, f in fps.items()}


@settings(max_examples=100, deadline=None)
@given(value=st.integers(0, (1 << 64) - 1), flips=st.sets(st.integers(0, 63), max_size=3))
def test_close_fingerprints_share_an_anchor(value, flips):
    other = value
    for f in flips:
        other ^= 1 << f
    index, anchor, cost = simhash.anchors(np.array([value, other], dtype=np.uint64), 2)
    a, b = (dict(zip(anchor[index == k].tolist(), cost[index == k].tolist(), strict=True)) for k in (0, 1))
    assert any(a[x] + b[x] <= 3 and min(a[x], b[x]) <= 1 for x in a.keys() & b.keys())
    assert max(cost) <= 2 and sum(cost[index == 0] == 0) == 1


def near_cluster(n, seed=3):
    """Fingerprints of which many lie close to each other, and lone ones."""
    rng, out = random.Random(seed), set()
    centre = rng.getrandbits(64)
    while len(out) < n:
        x = centre
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out | {rng.getrandbits(64) for _ in range(50)})


def test_large_groups_in_tiles(spark):
    fps = near_cluster(300)
    root = plain_components(dict(zip(fps, fps, strict=True)))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for limits in ({}, {"group": 20, "tile": 8}):
        found = simhash.fingerprint_links(df, 3, **limits)
        roots = {r.node % (1 << 64): r.root % (1 << 64) for r in components(found).collect()}
        parts, wanted = defaultdict(set), defaultdict(set)
        for f in fps:
            parts[roots.get(f, f)].add(f)
            wanted[root[f]].add(f)
        assert sorted(map(sorted, parts.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 1 for k in range(2, 41)}, **{k: 100 for k in range(101, 160)}, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Suffix-array dedup ------------------------------------------------------------
def plain_removal(texts: list[bytes]) -> list[tuple]:
    seen, out = set(), []
    for raw in texts:
        covered = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            h = hash(w)
            if h in seen:
                covered[s : s + 100] = b"\1" * 100
            seen.add(h)
        runs = len(re.findall(rb"\x01+", bytes(covered)))
        out.append((len(raw), sum(covered), runs, hashlib.sha256(bytes(x for x, c in zip(raw, covered, strict=True) if not c)).hexdigest()))
    return out


def check_removal(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == dict(enumerate(plain_removal([(t or "").encode() for t in texts])))


def noise(rng, n):
    return "".join(rng.choice("abcdefgh ijkl\nmnopqrstuvwxyzäß") for _ in range(n))


def test_removal_of_common_passages(spark):
    """A passage that many texts share, each in a context of its own (which
    spreads its anchors), copies, near copies and shifted parts."""
    rng = random.Random(5)
    line, base = noise(rng, 130), noise(rng, 900)
    texts = [noise(rng, rng.randrange(10, 90)) + line + noise(rng, rng.randrange(10, 90)) for _ in range(150)]
    texts += [base, base, base[:450] + "#" + base[450:], base[100:500] + line + base[400:800], line, line[:99], line[:100], None, ""]
    check_removal(spark, texts)


def test_a_line_in_every_text_is_no_hot_group(spark):
    """One line of 144 bytes in 4,000 texts, between other words each time: its
    runs are all unequal and share anchors and sampled suffixes."""
    rng = random.Random(8)
    line = noise(rng, 144)[:144]
    texts = [noise(rng, rng.randrange(120, 200)) + line + noise(rng, rng.randrange(120, 200)) for _ in range(4000)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(16)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == dict(enumerate(plain_removal([t.encode() for t in texts])))
    docs, _ = suffix_dedup.ordered(df)
    docs = cut_lineage(docs)
    _, first = suffix_dedup.later_passes(docs, suffix_dedup.first_pass(docs).filter("not mark"))
    # Where groups are counted, a task's part result has a row for each window.
    parts = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in parts and "Window" not in parts and "partial_count" in parts


def test_removal_in_periodic_and_binary_like_texts(spark):
    rng = random.Random(6)
    texts = ["a" * 1000, "ab" * 400, "a" * 99, "a" * 100, "abc " * 300 + noise(rng, 120) + "abc " * 100]
    texts += ["".join(rng.choice("ab") for _ in range(600)) for _ in range(6)] + ["".join(rng.choice("ab") for _ in range(7)) * 60 for _ in range(6)]
    check_removal(spark, texts)


def test_removal_in_texts_longer_than_a_chunk(spark):
    rng = random.Random(7)
    part = noise(rng, 300_000)
    check_removal(spark, [part * 5 + noise(rng, 1000) + part[1000:2000], noise(rng, 500) + part[299_000:] + part[:1500]])


def test_removal_edge_table(edge, none, rows):
    order = sorted(rows, key=lambda r: (key(r[0]), r[1] is not None, (r[1] or "").encode()))
    wanted = sorted((str(r[0]), *x) for r, x in zip(order, plain_removal([(r[1] or "").encode() for r in order]), strict=True))
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in suffix_dedup.remove_repeats(edge).collect()) == wanted
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_removal_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in documents(spark, sf_dir).collect())
    wanted = [(k, *x) for (k, _), x in zip(docs, plain_removal([t.encode() for _, t in docs]), strict=True)]
    assert sorted(map(tuple, QUERIES["op5_suffix_dedup"](spark, sf_dir).collect())) == wanted
