"""Links of vectors against all pairs: many lengths, many lists, groups of copies."""

from __future__ import annotations

import functools

import numpy as np
import pytest

from tests.test_skew import shuffled_records
from tidemark.llm import vectors
from tidemark.llm.common import Forest


def all_pairs(rows, threshold=0.98):
    """Number of links and smallest reachable id of every row, by comparing all."""
    links = {i: set() for i, _, _ in rows}
    for i, v, label in rows:
        for j, w, other in rows:
            if i != j and label == other and len(v) == len(w):
                a, b = np.array(v), np.array(w)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links[i].add(j)
    root = {i: i for i in links}
    for _ in rows:
        step = {i: min([root[i], *(root[j] for j in links[i])]) for i in links}
        if step == root:
            break
        root = step
    return {i: (len(links[i]), root[i]) for i in links}


def found(spark, rows, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(table, **more).collect()}


def test_more_lengths_than_indexes(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MAX_DIMS", 2)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=(4, 4, 3, 5, 1, 2)[i % 6]).tolist(), i % 2) for i in range(300)]
    assert found(spark, rows) == all_pairs(rows)


@pytest.mark.parametrize("lists", [1, 40])
def test_groups_of_lists(spark, lists):
    """Chains of near vectors that cross the borders of lists, and a third of the rows near one vector."""
    rng = np.random.default_rng(5)
    rows, at = [], rng.normal(size=8)
    for i in range(240):
        at = at + rng.normal(size=8) * 0.08 * np.linalg.norm(at) / np.sqrt(8)
        rows.append((i, at.tolist(), 1))
    hot = rng.normal(size=8)
    rows += [(i, (hot + rng.normal(size=8) * 0.02).tolist(), 1) for i in range(240, 360)]
    want = all_pairs(rows)
    assert found(spark, rows, lists=lists, fit_rows=100) == want and max(n for n, _ in want.values()) > 100


def test_block_whose_candidates_are_all_too_far(spark, monkeypatch):
    """Blocks of two rows on one list: rough codes pass pairs on, and no exact cosine of a block reaches the threshold."""
    monkeypatch.setattr(vectors, "links", functools.partial(vectors.links, block=2))
    rng = np.random.default_rng(9)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.5).tolist(), 1) for i in range(40)]
    rows += [(i + 40, [c * 2 + 0.01 for c in rows[i][1]], 1) for i in range(5)]
    want = all_pairs(rows)
    assert found(spark, rows, lists=1, fit_rows=10) == want and 10 <= sum(n for n, _ in want.values()) < 40


def test_labels_of_many_blocks(spark, monkeypatch):
    """Blocks of six rows in cells of lists beside a label of one block: chains, and a third of the rows near one vector."""
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 6 * 8 * 8)
    rng = np.random.default_rng(15)
    rows, at = [], rng.normal(size=8)
    for i in range(160):
        at = at + rng.normal(size=8) * 0.08 * np.linalg.norm(at) / np.sqrt(8)
        rows.append((i, at.astype(np.float32 if i % 3 else float).tolist(), i % 40 // 25))
    hot = rng.normal(size=8)
    rows += [(i, (hot + rng.normal(size=8) * 0.02).tolist(), 0) for i in range(160, 240)]
    rows += [(i, (hot + rng.normal(size=8) * 0.02).tolist(), 2) for i in range(240, 245)]
    rows += [(i + 245, rows[i][1], rows[i][2]) for i in range(3)]
    want = all_pairs(rows)
    assert found(spark, rows, lists=30, fit_rows=100) == want and max(n for n, _ in want.values()) > 75


def test_vectors_are_not_copied_for_pairs_of_lists(spark):
    """A label of one block crosses the shuffle once, whatever lists its vectors visit."""
    rng = np.random.default_rng(16)
    x = rng.normal(size=(5000, 16))
    table = spark.createDataFrame([(i, 1, 16, v.tolist(), 1) for i, v in enumerate(x)], "cid long, label int, dim int, vec array<double>, copies long")
    assert shuffled_records(vectors.links(table, {16: vectors.fit(x, 32)})) <= 1.1 * len(x)


def test_trees_of_linked_pairs():
    rng = np.random.default_rng(17)
    forest, label = Forest(300), np.arange(300)
    for _ in range(4):
        a, b = rng.integers(0, 300, 60), rng.integers(0, 300, 60)
        forest.link(a, b)
        for i, j in zip(a, b, strict=True):
            label[np.isin(label, label[[i, j]])] = label[[i, j]].min()
        assert (forest.label == label).all()
