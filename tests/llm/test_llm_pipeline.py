import hashlib
import re

import public_tokenizers
import pytest

import corpus_pipeline
from tessera.llm.bpe import ByteBpe, read_ranks
from tessera.llm.common import cut_lineage, documents
from tessera.llm.simhash import fingerprint


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs = [cut_lineage(documents(spark, sf_dir))]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(cut_lineage(stage(spark, docs[-1], sf_dir)))
    return docs


def test_stages(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "encoding"]
    assert all(d.columns == outputs[0].columns for d in outputs[:-1])
    assert 0 < outputs[1].count() < outputs[0].count()


def test_exact_then_near(outputs):
    best = {}
    for r in outputs[1].collect():
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    kept = {r.doc_id: r.text for r in outputs[2].collect()}
    assert {v: k for k, v in best.items()} == kept
    fps = {k: fingerprint(t) for k, t in kept.items()}
    near = {r.doc_id for r in outputs[3].collect()}
    assert len(near) == outputs[3].count()
    groups = {}
    for k in sorted(fps):  # smallest id that links reach
        reach, todo = {k}, [k]
        while todo:
            x = todo.pop()
            new = [y for y in fps if y not in reach and (fps[x] ^ fps[y]).bit_count() <= 3]
            reach.update(new)
            todo += new
        groups[k] = min(reach)
    assert near == set(groups.values())


def test_mixed_then_encoded(outputs):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    whole, size, taken = {}, 0, 0
    for r in outputs[3].collect():
        whole[r.doc_id] = r
        size += count(r.text)
    rows = outputs[4].collect()
    assert all(r.source == whole[r.doc_id].source for r in rows)
    taken = sum(count(r.text) for r in rows)
    assert abs(taken - 1.5 * size) <= 20
    codec = ByteBpe(*read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    wanted = sorted((r.doc_id, hashlib.sha256(b"".join(codec.encode(r.text))).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in rows)
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in outputs[5].collect()) == wanted


def test_empty_table(spark, sf_dir, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_edges(spark, sf_dir, edge):
    docs = edge
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        assert name == "encoding" or docs.columns == edge.columns
    assert docs.count() > 0
