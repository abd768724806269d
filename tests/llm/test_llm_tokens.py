import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe, token_counts
from tessera.llm.common import documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    return bpe.ByteBpe(*bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return token_counts._table(*token_counts.read_merges(JSON))


@pytest.fixture(scope="module")
def counter():
    return Tokenizer.from_file(JSON)


def ids_of(library, text):
    return np.array(library.encode_ordinary(text or ""), dtype="<u4").tobytes()


def test_perfect_hash_is_minimal_and_exact(codec):
    index, keys = codec.index, list(codec.ranks)
    assert sorted(index.values.tolist()) == list(range(len(keys))) and index.find(keys) == list(range(len(keys)))
    absent = [k + b"\xffno" for k in keys[:500]]
    assert index.find(absent) == [-1] * 500 and index.find([]) == []


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text_as_the_libraries(codec, library, table, counter, text):
    ids = b"".join(codec.encode(text))
    assert ids == ids_of(library, text)
    assert codec.decode(ids) == text.encode()
    assert table.counts([text]) == [len(counter.encode(text, add_special_tokens=False).ids)]


@settings(max_examples=200, deadline=None)
@given(piece=st.lists(st.sampled_from([b"a", b"aa", b"the", b"th", b"\xc3", b"\xa9", b"e", b" "]), min_size=1, max_size=30).map(b"".join))
def test_heap_merges_lowest_rank_leftmost_first(codec, piece):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        ranks = [(codec.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        if not ranks or min(ranks)[0] == 1 << 60:
            break
        i = min(ranks)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    assert bpe.merge_bytes(piece, codec.ranks) == [codec.ranks[p] for p in parts]


def test_long_texts_are_split_in_runs(codec, library, table, counter):
    for text in ("word and 12, " * 120_000, "é" * 3000 + "ab " * 400_000):
        assert b"".join(codec.encode(text)) == ids_of(library, text)
        assert table.counts([text]) == [len(counter.encode(text, add_special_tokens=False).ids)]


def test_small_memo_forgets_but_stays_right(codec, library):
    codec.memo.known.clear()
    codec.memo.most, most = 20, codec.memo.most
    try:
        text = " ".join(f"w{k}x" for k in range(300))
        assert b"".join(codec.encode(text)) == ids_of(library, text)
    finally:
        codec.memo.most = most


def test_edge_table(edge, none, rows, library, counter):
    digests = bpe.bpe_digests(edge, RANKS, public_tokenizers.PATTERN).collect()
    wanted = sorted((str(r[0]), len(ids_of(library, r[1])) // 4, hashlib.sha256(ids_of(library, r[1])).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests) == wanted
    encoded = bpe.encoded_documents(edge, RANKS, public_tokenizers.PATTERN)
    assert set(encoded.columns) == set(edge.columns) | {"ids_sha256", "decoded_sha256"}
    back = bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).select("doc_id", "text", "decoded", "n_tokens", "ids").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(r.ids) for r in back)
    counts = token_counts.token_counts(edge, JSON, limit=512).collect()
    n = lambda t: len(counter.encode(t or "", add_special_tokens=False).ids)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counts) == sorted((str(r[0]), len((r[1] or "").encode()), n(r[1]), n(r[1]) > 512) for r in rows)
    for op in (bpe.bpe_digests(none, RANKS, public_tokenizers.PATTERN), bpe.encoded_documents(none, RANKS, public_tokenizers.PATTERN), token_counts.token_counts(none, JSON)):
        assert op.count() == 0


def test_queries_as_the_libraries(spark, sf_dir, library, counter):
    import __spark_entry__

    texts = {r.doc_id: r.text for r in documents(spark, sf_dir).collect()}
    got = __spark_entry__.queries()["op2_bpe"](spark, sf_dir).collect()
    assert {r.doc_id: r.ids_sha256 for r in got} == {k: hashlib.sha256(ids_of(library, t)).hexdigest() for k, t in texts.items()}
    got = __spark_entry__.queries()["op10_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(counter.encode(t, add_special_tokens=False).ids) for k, t in texts.items()}


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.read_merges(public_tokenizers.path("word_bpe_49k.json"))
