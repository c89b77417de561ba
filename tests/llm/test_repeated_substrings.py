"""Repeated byte strings against counting every window."""

from __future__ import annotations

import hashlib
import random

import pytest

from tests.llm import brute
from tidemark.llm import substrings
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def found(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


def wanted(docs, size):
    return sorted(brute.without_repeats(docs, size), key=repr)


def test_query_matches_counting_every_window(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {tuple(r) for r in QUERIES["op12_prefix_free_parsing"](spark, SMALL).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    want = {(i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in brute.without_repeats(docs)}
    assert got == want and len(got) == len(docs) and sum(r[2] for r in got) > 100_000


@pytest.mark.parametrize("size", [400, 70, 9])
def test_passages_between_other_text(spark, size):
    rng = random.Random(size)

    def noise(most):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(rng.randint(0, most)))

    passages = [noise(0) + "".join(rng.choice("xyz ü") for _ in range(rng.randint(size - 5, size + 150))) for _ in range(6)]
    rows = [(None, None), (1, ""), (2, "a" * 1200), (3, "a" * 700 + "b" * 50), (None, passages[0])]
    for k in range(4, 40):
        text = noise(200) + rng.choice(passages) + noise(300) + rng.choice(passages)[rng.randint(0, 30) :] + noise(100)
        rows.append((k, text))
    # the same id and text twice, the same id with other text, the same text under another id
    rows += [rows[6], rows[6], (7, noise(900)), (99, rows[8][1]), (100, passages[1][: size - 1])]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, data string, digest int")
    assert found(substrings.without_repeats(docs, size=size)) == wanted(rows, size)


def test_slices_of_the_sorted_windows_meet(spark, monkeypatch):
    """A window so frequent that it fills several slices is found in all of them."""
    monkeypatch.setattr(substrings, "ENTRIES_PER_TASK", 40)
    rng = random.Random(1)
    common = "".join(rng.choice("abcdefghijklmnop ") for _ in range(70))
    rows = [(k, "".join(rng.choice("qrstuvwxyz") for _ in range(50)) + common + str(k) * 50) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = wanted(rows, 64)
    assert found(substrings.without_repeats(docs, size=64)) == want and all(s for _, _, s, _ in want)


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "PIECE", 1 << 12)
    rng = random.Random(2)
    part = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(60_000))
    rows = [(1, part + "x" * 20_000 + part[:30_000]), (2, "y" + part[100:50_000]), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(substrings.without_repeats(docs)) == wanted(rows, 400)


def test_every_window_is_in_one_block():
    rng = random.Random(3)
    for size in (8, 30, 400):
        for n in (0, size - 1, size, size + 1, 3000):
            data = bytes(rng.choice(b"ab c") for _ in range(n // 2)) + b"shortperiod " * (n // 24) + b"z" * n
            data = data[:n]
            starts = [at - k for _, at, far, near in substrings.blocks_of(data, size) for k in range(near, far + 1)]
            assert sorted(starts) == list(range(n - size + 1))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.without_repeats(docs).collect() == []
    with pytest.raises(ValueError):
        substrings.without_repeats(docs, size=3)
