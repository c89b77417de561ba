"""The pipeline against the same five stages in plain Python over all pairs."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import quality
from tidemark.llm.common import table
from tidemark.llm.queries import TARGETS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    return corpus_pipeline.run(spark, SMALL).collect()


def test_whole_pipeline(spark, result):
    documents, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    net = quality.fit(documents, labels)
    docs = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    docs = [d for d in docs if quality.score_texts([d[1].encode()], net)[0] >= 0.5]
    texts = brute.deduplicated([d[:2] for d in docs])
    docs = [(d[0], texts[d[0]], d[2]) for d in docs]
    prints = {d[0]: brute.fingerprint(d[1]) for d in docs}
    roots = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    docs = [d for d in docs if roots[d[0]] == d[0]]
    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    docs = [d for d in docs if not any(brute.holds_item(d[1], item) for item in items)]
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(text)
    weights = {s: TARGETS.get(s, 1.0) for s in sizes}
    want = {}
    for doc_id, text, source in docs:
        rate = weights[source] * sum(sizes.values()) / (sum(weights.values()) * sizes[source]) if sizes[source] else 1.0
        if n := brute.copies(doc_id, rate):
            want[doc_id] = (text, n)
    got = {}
    for row in result:
        got[row.doc_id] = (row.text, got.get(row.doc_id, ("", 0))[1] + 1)
    assert got == want and len(want) > 20


def test_stages(spark, result):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontaminate", "mix"]
    assert {"doc_id", "text", "lang", "source", "n_chars"} < set(result[0].asDict())
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0
    assert all(r.n_chars == len(r.text) for r in result)
