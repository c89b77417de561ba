"""Disclosing terms: one person in many documents, and every kind of word."""

from __future__ import annotations

import pytest

from tests.llm import brute
from tidemark.llm import privacy

SCHEMA = "doc_id long, text string"
OTHER = [(1000 + k, f"plain text number{k} of the desk") for k in range(60)]


def term_spans(spark, docs):
    rows = privacy.found(spark.createDataFrame(docs + OTHER, SCHEMA)).collect()
    return {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind == len(privacy.KINDS)] for r in rows}


def test_a_name_beside_one_address_in_many_documents(spark):
    docs = [(k, f"Quimby wrote on day{'abcdefghijklmnopqrst'[k]} from jq@mail.org to the desk") for k in range(20)]
    got = term_spans(spark, docs)
    assert all("Quimby" in got[k] for k in range(20)) and not any(got[k] for k, _ in OTHER)


def test_copies_of_one_text_do_not_count(spark):
    docs = [(k, "Quimby wrote from jq@mail.org to the desk") for k in range(20)]
    assert not any(term_spans(spark, docs).values())


def test_numbers_mixed_ids_and_marks_are_words(spark):
    hindi = "हिन्दी"
    docs = [(k, f"K-48213 and user0042 and {hindi} by mail{k}@mail.org, call +49 30 1234567{k:02} or 4111 1111 1111 1111 for desk") for k in range(20)]
    docs += [(100 + k, f"user{k} and K-{k} of the desk") for k in range(20)]
    got = term_spans(spark, docs)
    for k in range(20):
        assert {"48213", "user0042", hindi} <= set(got[k]) and not {"4111", "49", "1111"} & set(got[k])
    assert not any(got[100 + k] for k in range(20)) and not any(got[k] for k, _ in OTHER)


def test_words_whose_lower_case_is_longer_or_hangs_on_neighbours(spark):
    """A dotted capital I has two code points in lower case; a final sigma depends on what follows."""
    docs = [(k, f"İsmet and ΟΔΟΣ.Α and Straße wrote n{k} from is{k}@mail.org to the desk") for k in range(20)]
    docs += [(100 + k, f"İSMET or ΟΔΟΣ n{k} of the desk") for k in range(2)]
    rows = privacy.found(spark.createDataFrame(docs + OTHER, SCHEMA)).collect()
    want = brute.term_spans(docs + OTHER)
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == len(privacy.KINDS)] for r in rows}
    assert got == want
    assert all("İsmet" not in r.sanitised and "ΟΔΟΣ" not in r.sanitised for r in rows if r.doc_id < 100)


@pytest.mark.parametrize("support", [2, 10])
def test_all_spans_of_the_test_documents(spark, support):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    texts = dict(rows)
    terms, found = brute.term_spans(rows, support), 0
    for row in privacy.digests(privacy.found(docs, support=support)).select("doc_id", "spans").collect():
        want = [f"{k}:{a}:{b}" for k, a, b in brute.personal_data(texts[row.doc_id])] + [f"term:{a}:{b}" for a, b in terms[row.doc_id]]
        assert row.spans == ",".join(want)
        found += len(terms[row.doc_id])
    assert found > 0 or support > 2
