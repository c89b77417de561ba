"""Spelling variants against trying every edit of every word."""

from __future__ import annotations

from tests.llm import brute
from tidemark.llm import variants
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query_finds_every_neighbour(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute.spelling_variants(brute.spelling_words(docs))
    got = QUERIES["op11_permuterm_variants"](spark, SMALL)
    assert found(got) == want and got.count() == len(want)
    assert sum(1 for form, *_ in want.values() if form) > 100


def test_chains_ties_and_repeated_letters(spark):
    times = {
        "bookkeeper": 200, "bokkeeper": 30, "bokeeper": 5, "bookkeeperr": 30, "abcdef": 26, "abcdeg": 25, "abcdeh": 25, "abcde": 90,
        "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "ççççççç": 7, "ççççççé": 40, "lonely": 6,
    }
    text = " ".join(w for w, n in times.items() for _ in range(n))
    rows = [(1, text), (1, "BookKeeper Ünder"), (2, None), (None, "Straße $ x́ lonely"), (3, ""), (4, "7 _ \t\n")]
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, word string")
    want = brute.spelling_variants(brute.spelling_words(rows))
    assert found(variants.variants(docs)) == want
    assert want["abcdeh"][0] is None and want["aaaaaa"][1] == "aaaaaaaa" and len(want["lonely"]) == 5


def test_dropped_characters_and_very_long_texts(spark):
    text = "wordlike " * 300_000
    rows = [(k, f"wordlike number{chr(97 + k % 26)}ing " * 20) for k in range(900)] + [(1000, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute.spelling_variants(brute.spelling_words(rows))
    assert found(variants.variants(docs)) == want and any(r[0] for r in want.values())


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "short"), (2, None)], "doc_id long, text string")
    assert variants.variants(docs).count() == 0
    assert variants.variants(docs.limit(0)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_sorted_scan_across_batches(spark):
    """A stretch that is cut by the end of an Arrow batch counts as one."""
    words = [(f"{a}{b}cdefgh", 5 + k) for k, (a, b) in enumerate((a, b) for a in "abcdefghij" for b in "klmnopqrst")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.word: r.n_near for r in variants.neighbours(spark.createDataFrame(words, "word string, n long")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {w: 18 for w, _ in words}
