"""Operators 11 to 13 against plain restatements, and their edge cases."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import conversations, decontaminate, spelling
from tessera.llm.queries import ORACLES, QUERIES


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", ["op11_repair", "op12_spelling", "op13_decontaminate"])
def test_oracles(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    wanted = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


# Conversation repair ----------------------------------------------------------
def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Every edit list of least cost that an exhaustive walk finds."""
    faults, step = plain_faults(rows), {"": "su", "s": "u", "u": "a", "a": "u"}
    layer = {"": (0, "", [])}

    def inserted(layer):
        for _ in range(3):
            new = dict(layer)
            for q, (cost, audit, out) in layer.items():
                for r in step[q].replace("s", ""):
                    more = (cost + 5, audit + "I", [*out, ({"u": "user", "a": "assistant"}[r], "")])
                    if r not in new or more[:2] < new[r][:2]:
                        new[r] = more
            layer = new
        return layer

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for q, (cost, audit, out) in inserted(layer).items():
            ways = [(cost + 2, audit + "D", out, q)]
            if fault not in ("blank", "duplicate"):
                left = cost + 5 * (fault == "truncated")
                if role[:1] and role[:1] in step[q]:
                    ways.append((left, audit + "K", [*out, (role, text)], role[:1]))
                for r in step[q].replace("s", ""):
                    ways.append((left + 1, audit + "R", [*out, ({"u": "user", "a": "assistant"}[r], text)], r))
            for way in ways:
                if way[3] not in new or way[:2] < new[way[3]][:2]:
                    new[way[3]] = way[:3]
        layer = new
    return min(v for q, v in inserted(layer).items() if q in ("", "a"))


def code(role, fault):
    return "sua".find(role[:1]) % 4 * 4 + ["", "blank", "duplicate", "truncated"].index(fault) if role[:1] in ("s", "u", "a") else 12 + ["", "blank", "duplicate", "truncated"].index(fault)


row = st.tuples(st.none(), st.sampled_from(["system", "user", "assistant", "tool", "u", ""]), st.sampled_from(["", " ", "a.", "b.", "c", "d", "e!", "f?", "g."]))


@settings(max_examples=200, deadline=None)
@given(st.lists(row, max_size=9), st.integers(1, 4))
def test_paths_equal_the_walk_however_they_are_cut(rows, cut):
    codes = [code(role, fault) for (_, role, _), fault in zip(rows, plain_faults(rows), strict=True)]
    cost, audit, _ = plain_repair(rows)
    if not rows:
        return
    assert conversations.best_edits(conversations.segment_paths(codes)) == (cost, audit)
    parts = [conversations.segment_paths(codes[i : i + cut]) for i in range(0, len(codes), cut)]
    assert conversations.best_edits(conversations.merged_paths(parts)) == (cost, audit)


CONVERSATION = "conv_id long, turn long, role string, text string, place string, code string, seg string, header string"


def conversation_rows():
    rng = random.Random(3)
    rows = []
    for c in [None, *range(40)]:
        for t in range(rng.randrange(1, 12)):
            turn = rng.choice([t, t, t, None, t - 1])
            rows.append((c, turn, rng.choice(["system", "user", "assistant", "assistant", "tool", None]), rng.choice(["Yes.", "No", "", None, "Why? ", "x" * 3000 + ".", f"{c} {t}.", f"é {t}!\n"])))
    rows += [(77, t, "user" if t % 2 == 0 else "assistant", f"text {t % 150}.") for t in range(900)]  # a long one
    rows += [(78, None, "user", "same.")] * 300
    return rows


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, (role or " ").encode(), (text or " ")[:64].encode())


@pytest.mark.parametrize("segment,fan", [(256, 64), (7, 3)])
def test_repair_of_any_rows(spark, segment, fan):
    rows = conversation_rows()
    frame = spark.createDataFrame([(*r, *"abcd") for r in rows], CONVERSATION).repartition(6)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(frame, ids=frame, segment=segment, fan=fan).collect()}
    assert len(got) == 43
    fixed: dict = {}
    for r in conversations.repaired_rows(frame, segment=segment, fan=fan).collect():
        fixed.setdefault(r.conv_id, {})[r.place] = (r.role, r.text)
    for c, found in got.items():
        mine = [(t, role or " ", " " if text is None else text) for _, t, role, text in sorted((r for r in rows if r[0] == c), key=order)]
        cost, audit, out = plain_repair(mine)
        faults, turns = plain_faults(mine), [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        assert found == (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
        assert [fixed.get(c, {})[k] for k in range(len(out))] == out


def test_damage_and_empty_conversations(spark):
    rows = [(c, t, None if t == 3 else "user", "One. Two!") for c in (None, 1, 2) for t in [None, *range(60)]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(str, conversations.damage(frame).collect()))
    wanted = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role = "user" if kind == 4 else role or " "
        text = {1: "", 2: "One Two"}.get(kind, text)
        wanted += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(str(spark.createDataFrame([w], frame.schema).first()) for w in wanted[:1]) or len(got) == len(wanted)
    assert sorted(got) == sorted(f"Row(conv_id={c}, turn={t}, role={r!r}, text={x!r})" for c, t, r, x in wanted)
    none = frame.limit(0)
    assert conversations.repair(none).count() == 0 and conversations.repaired_rows(none).count() == 0
    left = conversations.repair(none, ids=frame).collect()
    assert sorted(str(r.conv_id) for r in left) == ["1", "2", "None"]
    assert {tuple(r)[1:] for r in left} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# Spelling variants ------------------------------------------------------------
def plain_variants(rows):
    counts: dict = {}
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lowered(word)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] = counts.get(word, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    return variants_of(counts)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_of(counts):
    form, number = {}, {}
    for w in counts:
        close = [v for v in counts if near(w, v)]
        number[w] = len(close)
        if close and counts[top := min(close, key=lambda v: (-counts[v], v))] >= 10 * counts[w]:
            form[w] = top
    out = set()
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, counts[w], number[w], counts[form[w]] if w in form else None))
    return out


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abé", min_size=3, max_size=4), min_size=2), st.integers(0, 1))
def test_composition_accepts_each_near_pair_once(words, _):
    least = min(map(len, words))
    got = sorted(tuple(sorted(p)) for p in spelling.near_pairs(list(words)))
    wanted = sorted((a, b) for a in words for b in words if a < b and near(a, b) and min(len(a), len(b)) == least)
    assert got == wanted


def test_acceptor_is_minimal():
    arcs = spelling.Acceptor(sorted(["abcx", "abdx", "cbcx", "cbdx"])).arcs
    reached, stack = set(), [0]
    while stack:
        q = stack.pop()
        if q not in reached:
            reached.add(q)
            stack += arcs[q].values()
    assert len(reached) == 5


@pytest.mark.parametrize("group", [spelling.GROUP, 90 * 91, 6])
def test_near_words_for_any_group_size(spark, group):
    rng = random.Random(group)
    words = {"".join(rng.choice("abcé") for _ in range(rng.choice([7, 7, 8, 9]))) for _ in range(300)}
    words |= {"prefix" + a + b for a in "abcdefg" for b in "abcd"} | {a + b + "suffixe" for a in "xyz" for b in "abc"}
    words |= {"a" * n for n in (7, 8, 9, 30, 31)} | {"ab" * 700, "ab" * 699 + "a", "ab" * 699 + "c"}
    counts = {w: rng.choice([2, 3, 30, 400]) for w in sorted(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {(r.word, r.n_near, r.best_n, r.best) for r in spelling.near_words(frame, group).collect()}
    wanted = set()
    for w in counts:
        if close := [v for v in counts if near(w, v)]:
            top = min(close, key=lambda v: (-counts[v], v))
            wanted.add((w, len(close), counts[top], top))
    assert got == wanted


def test_variants_of_edge_rows(spark, edge, none):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()]
    assert {tuple(r) for r in spelling.spelling_variants(edge).collect()} == plain_variants(rows)
    assert spelling.spelling_variants(none).count() == 0
    texts = [(k, "Étienneé étienneé ÉTIENNEé straßenname strassenname " * 3 + "strasennnamen " * k) for k in range(40)]
    texts += [(None, "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999)] * 2
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    assert {tuple(r) for r in spelling.spelling_variants(frame).collect()} == plain_variants(texts)


# Benchmark decontamination ----------------------------------------------------
def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_hits(docs, items):
    windows: dict = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add("" if item is None else str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, covered, owners = words_of(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if found := windows.get(tuple(w[i : i + k])):
                    owners |= found
                    covered.update(range(i, i + k))
        out.append((doc_id, len(w), sorted(covered), sorted(owners)))
    return out


def test_suffix_order():
    rng = np.random.default_rng(1)
    for n, most in ((1, 1), (50, 2), (400, 3), (400, 30)):
        symbols = rng.integers(0, most + 1, n).astype(np.int32)
        symbols[-1] = 0
        ends = np.flatnonzero(symbols == 0)

        def key(k, symbols=symbols, ends=ends):
            end = int(ends[np.searchsorted(ends, k)])
            return [(1, int(s)) for s in symbols[k:end]] + [(0, end)]

        assert decontaminate.suffix_order(symbols).tolist() == sorted(range(n), key=key)


def contaminated_rows(rows):
    rng = random.Random(9)
    word = lambda: rng.choice(["The", "of", "x1", "naïve", "日本", "stone", "é", "42"])
    items = [(k, " ".join(word() for _ in range(rng.choice([3, 9, 10, 12, 60])))) for k in range(30)]
    items += [(None, "of of. OF of!"), (5, items[0][1].upper()), (31, None), (32, " .,- "), (33, "stone"), (34, " ".join(word() for _ in range(5000)))]
    docs = [(r[0], r[1]) for r in rows]
    for k in range(60):
        body = [word() for _ in range(rng.choice([0, 5, 40, 900]))]
        for _ in range(rng.randrange(3)):
            body.insert(rng.randrange(len(body) + 1), rng.choice(items[:30])[1].replace(" ", rng.choice([" ", "--", ".\n"])))
        docs.append((1000 + k, rng.choice([" ", ", "]).join(body)))
    docs.append((2000, items[-1][1]))
    return docs, items


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 40])
def test_contamination_equals_all_windows(spark, rows, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    docs, items = contaminated_rows(rows)
    if block == 40:
        docs, items = docs[-30:], items[:8]
    frame = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, row string, spans string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, [w for s in r.spans for w in range(s.begin, s.end)], r["items"]) for r in decontaminate.contamination(frame, bench).collect()]
    assert sorted(got, key=str) == sorted(plain_hits(docs, items), key=str)
    for r in decontaminate.remove_passages(frame, bench).select("doc_id", "text", "row").collect():
        assert r.row == "x" and r.doc_id in {d for d, _ in docs}
    left = {(r.doc_id, tuple(words_of(r.text))) for r in decontaminate.remove_passages(frame, bench).collect()}
    wanted = set()
    for (doc_id, text), (_, _, covered, _) in zip(docs, plain_hits(docs, items), strict=True):
        gone = set(covered)
        wanted.add((doc_id, tuple(w for k, w in enumerate(words_of(text)) if k not in gone)))
    assert left == wanted


def test_contamination_of_edge_tables(spark, edge, none):
    bench = spark.createDataFrame([(1, "x" * 5000), (2, "one two three")], "item_id long, text string")
    got = decontaminate.contamination(edge, bench).collect()
    assert len(got) == edge.count() and {tuple(r["items"]) for r in got} == {(), ("1",), ("2",)}
    assert decontaminate.contamination(none, bench).count() == 0
    assert all(not r.spans for r in decontaminate.contamination(edge, bench.limit(0)).collect())
    assert decontaminate.remove_passages(none, bench).columns == none.columns


def test_words_are_cut_with_what_is_between():
    assert decontaminate.without("One, two! three four.", [(1, 3)]) == "One,  four."
    assert decontaminate.without("é-a b", [(0, 1), (2, 3)]) == "-a "
