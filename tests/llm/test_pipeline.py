"""The pipeline's stages, each against brute force on its own input."""

import base64
import hashlib

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, edge_docs):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = edge_docs.withColumn("doc_id", edge_docs.doc_id + 100_000).select(docs.columns)
    out = [docs.unionByName(more).cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_columns_and_effect(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    counts = [s.count() for s in stages]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > counts[3]


def test_quality_stage(stages):
    from ferry.llm.quality import quality

    want = sorted((r.doc_id or 0) for r in quality(stages[0]).where("kept").collect())
    assert sorted((r.doc_id or 0) for r in stages[1].collect()) == want


def test_line_stage(stages):
    before = {(r.doc_id, r.text) for r in stages[1].collect()}
    for r in stages[2].collect():
        assert (r.doc_id, r.text) in before or r.n_chars == len(r.text)


def test_near_duplicate_stage(stages):
    from tests_llm_brute import brute_components

    rows = stages[2].collect()
    want = brute_components({r.doc_id: r.text for r in rows if r.doc_id is not None})
    assert sorted((r.doc_id or 0) for r in stages[3].collect()) == sorted((r.doc_id or 0) for r in rows if r.doc_id is None or want[r.doc_id][1] == r.doc_id)


def test_decontamination_stage(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = {" ".join(x.lower().split()[i : i + 6]) for x in items for i in range(len(x.split()) - 5)}
    left = {r.doc_id for r in stages[4].collect()}
    for r in stages[3].collect():
        if any(x in r.text for x in items):
            assert r.doc_id not in left
        elif r.doc_id not in left:
            assert any(x in " ".join(r.text.lower().split()) for x in words)


def test_token_stage(stages):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        if r.doc_id is not None:
            assert r.token_ids == enc.encode_ordinary(texts[r.doc_id])
            assert r.ids_sha256 == hashlib.sha256(np.array(r.token_ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_reads_and_writes(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "token_ids", "n_tokens"} <= set(rows.columns) and rows.count() > 100
