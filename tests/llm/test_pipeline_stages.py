from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from snapmart.llm import mixing, pii, toxicity
from snapmart.llm.common import documents, store
from tests.llm.spark_fixture import EDGE_ROWS, docs_of
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_pii import PATTERNS, naive


def test_stages_on_driver_documents(spark, sf_small):
    docs = documents(spark, sf_small)
    names = docs.columns
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, sf_small), "t")
        out.append(docs)
    assert all(d.columns == names for d in out[:-1])
    rows = [{r.doc_id: r for r in d.collect()} for d in out[:3]]
    source = {r.doc_id: r for r in documents(spark, sf_small).collect()}

    # Toxicity: what stays is unchanged and scores below the threshold.
    model = toxicity.train(documents(spark, sf_small), spark.read.parquet(f"{sf_small}/labels.parquet"))
    judged = {i: toxicity.judge(r.text, model, {})[0] for i, r in source.items()}
    assert {i for i, s in judged.items() if s < toxicity.THRESHOLD} == set(rows[0])
    assert all(r == source[i] for i, r in rows[0].items())

    # Near duplicates: exactly the smallest id of each component of what was left.
    components = brute_components([(i, r.text, r.source) for i, r in rows[0].items()])
    assert set(rows[1]) == {c for _, _, c in components}

    # Personal data: spans are replaced, everything else stays.
    for i, r in rows[2].items():
        before = rows[1][i].text
        assert re.sub(r"<(email|ip|card|phone)>", "", r.text) == r.text or r.text != before
        assert naive(before) or r.text == before
        assert not PATTERNS["email"].search(r.text) and r.n_chars == (len(r.text) if r.text != before else rows[1][i].n_chars)

    # Mixing: rows of the third stage, each as often as the operator says.
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(out[2]).collect()}
    assert Counter(r.doc_id for r in out[3].collect()) == Counter({i: n for i, n in copies.items() if n})

    # Packing: every taken copy is in the sequences with all its ids.
    held = Counter()
    whole = {}
    for r in out[4].collect():
        held[r.doc_id] += r.length
        whole[r.doc_id] = r.doc_tokens
    assert held == Counter({i: n * whole[i] for i, n in copies.items() if n})


def test_stages_take_edge_rows(spark, sf_small):
    for empty in (False, True):
        docs = docs_of(spark, EDGE_ROWS)
        docs = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, sf_small), "t")
        assert (docs.count() == 0) == empty


def test_mask_is_stable(spark):
    text = "write to a.b@c.org or 10.1.2.3"
    once = pii.mask(docs_of(spark, [(1, text, "s")])).collect()
    assert [r.text for r in once] == ["write to <email> or <ip>"]
