"""The registered queries on the small tables against SQL, or against plain Python over all pairs."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tests.compare import connect, differences
from tests.llm import brute
from tidemark.llm import decontaminate, quality, urls
from tidemark.llm.queries import ORACLE, QUERIES, RULES

SMALL = "/root/testdata/sf0.001"


def rows(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) == []


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in QUERIES["op3_quality_cnn"](spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    right = np.mean([r.predicted == labels[r.doc_id] for r in found])
    kept = np.mean([r.predicted for r in found if labels[r.doc_id] == 1])
    assert len(found) > 80 and right > 0.92 and kept > 0.95


def test_urls(spark):
    def rule_of(host, path):
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: len(r.name), default=None)

    model = urls.train()
    got = {r.page_id: r for r in QUERIES["op5_url_logistic"](spark, SMALL).collect()}
    for page_id, url, _ in rows(spark, "pages"):
        host, path = urls.plain_split(url)
        rule = rule_of(host, path)
        by_model = "block" if urls.score(host, path, model) >= 0.5 else "allow"
        want = (host, path, rule.name if rule else None, rule.verdict if rule else by_model)
        assert (got[page_id].host, got[page_id].path, got[page_id].rule, got[page_id].verdict) == want


def test_lines(spark):
    docs = [(d[0], d[1]) for d in rows(spark, "documents")]
    got = {r.doc_id: r for r in QUERIES["op6_line_minhash"](spark, SMALL).collect()}
    want = brute.deduplicated(docs)
    wrong = [i for i, _ in docs if got[i].text != want[i]]
    assert len(got) == len(docs) and sum(r.n_removed for r in got.values()) > 0
    # banding may miss a pair just above the threshold
    assert len(wrong) <= 0.01 * len(docs)


def test_simhash(spark):
    prints = {d[0]: brute.fingerprint(d[1]) for d in rows(spark, "documents")}
    want = brute.groups(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_bktree"](spark, SMALL).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    assert len(set(want.values())) < len(want)


def test_personal_data(spark):
    got = {r.doc_id: r for r in QUERIES["op9_pii_disclosure"](spark, SMALL).collect()}
    total = 0
    for doc_id, text, *_ in rows(spark, "documents"):
        spans = brute.personal_data(text)
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[doc_id].base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert got[doc_id].spans.startswith(told)
        total += len(spans)
    assert total > 0


def test_decontamination(spark):
    items = rows(spark, "benchmark")
    got = {(r.doc_id, r.item_id) for r in QUERIES["op10_bm25_decontaminate"](spark, SMALL).collect()}
    want = {(d[0], i) for d in rows(spark, "documents") for i, item in items if brute.holds_item(d[1], item)}
    assert got == want and want


def test_block_max_wand_finds_all_above_the_threshold():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}".encode() for k in range(60)]
    draw = lambda n: [vocabulary[int(k)] for k in rng.zipf(1.5, n) % 60]
    index = decontaminate.build_index([(k, b" ".join(draw(12)).decode()) for k in range(120)], block=8)
    for _ in range(60):
        asked = set(draw(30))
        scores = {n: sum(w / i.floor for t, w in i.weights.items() if t in asked) for n, i in enumerate(index.items)}
        got = dict(decontaminate.block_max_wand(index, asked))
        assert set(got) == {n for n, s in scores.items() if s >= 1}
        assert all(abs(got[n] - scores[n]) < 1e-9 for n in got)


def test_network_covers_the_whole_text():
    net = quality.train([b"good words here " * 40, b"BAD!! BAD!! " * 60] * 12, np.array([1.0, 0.0] * 12), epochs=20)
    long_good = b"good words here " * 3000
    assert quality.score_texts([long_good], net)[0] > 0.5
    assert quality.score_texts([long_good + b"BAD!! BAD!! " * 6000], net)[0] < quality.score_texts([long_good], net)[0]


def test_network_against_a_plain_loop():
    """Convolution, pooling and combination written out, one byte at a time."""
    rng = np.random.default_rng(5)
    texts = [b"", b"a", bytes(rng.integers(0, 256, 255)), b"plain words " * 21, "é漢".encode() * 200, bytes(rng.integers(0, 256, 2000))]
    net = quality.train([b"good words here " * 40, b"BAD!! BAD!! " * 60] * 6, np.array([1.0, 0.0] * 6), epochs=3)
    for text, got in zip(texts, quality.score_texts(texts, net), strict=True):
        filters = range(len(net.bias))
        tops, start = [], 0
        while True:  # chunks of 256 bytes, 192 apart, until one reaches the end
            best = [-math.inf] * len(net.bias)
            for at in range(start, start + 256, 2):
                byte = [text[at + j] if at + j < len(text) else 256 for j in range(8)]
                for f in filters:
                    best[f] = max(best[f], sum(float(net.table[j, byte[j], f]) for j in range(8)))
            tops.append([max(0.0, best[f] + float(net.bias[f])) for f in filters])
            if start + 256 >= len(text):
                break
            start += 192
        z = float(net.intercept)
        for f in filters:
            column = [t[f] for t in tops]
            z += sum(column) / len(column) * float(net.mean_weight[f]) + max(column) * float(net.max_weight[f])
        assert abs(got - 1 / (1 + math.exp(-z))) < 1e-4
