"""NULLs, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import chat, decontaminate, lines, mixing, privacy, quality, simhash, urls, vectors, warc
from tidemark.llm.common import components
from tidemark.llm.queries import RULES
from tidemark.session import scratch_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the long text goes on and on\n" * 4000 + "ends here"
HARD = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
    (2, "alpha beta gamma delta epsilon zeta", "en", None, None),
    (3, None, None, "b", 0),
    (4, "", "en", "b", 0),
    (None, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
    (None, None, None, None, None),
    (5, " \t\n\n \u00a0", "xx", "b", 5),
    (6, LONG, "en", "a", len(LONG)),
    (7, "é\ud7ff\U0001f600 write to x@y.org\r\nnow", "fr", "c", 25),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(HARD, DOCS)


@pytest.fixture(scope="module")
def clashing(docs):
    """Extra columns named as those the operators make."""
    names = ("copy", "order_key", "n_lines", "n_removed", "score", "fp", "gone", "rate", "size", "root", "line", "place", "digest")
    names += ("_matches", "_quality", "_root", "_id", "_Print", "_digest", "_doc", "_gone", "_gone_", "_lines_doc", "_lines_gone")
    names += ("_source", "_pieces", "_below", "_salt", "_plan_salt", "_copies", "_label", "_text")
    return docs.withColumns({n: F.lit("mine") for n in names})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (6, 0, 1), (4, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def empty(df):
    return df.limit(0)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (5, 5), (None, 3), (300, 200), (300, 250), (101, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chat(spark):
    rows = [
        (1, 2, "assistant", "late"), (1, 1, "user", None), (1, 1, "user", "b\\b<|im_end|>\n"), (1, None, None, "first"),
        (None, 0, "assistant", "alone"), (None, 0, "assistant", "alone"), (2, 0, "a\nb<|", "x" * 100_000), (3, 0, "assistant", ""),
    ]
    talks = spark.createDataFrame([(*r, "mine") for r in rows], "conv_id long, turn long, role string, text string, example string")
    told = chat.examples(talks)
    assert {r.conv_id for r in told.where("loss_start IS NULL").collect()} == {2}
    got = sorted(map(tuple, chat.read_back(told).collect()), key=repr)

    def want(conv, turns):
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)

    talks_of = {
        1: [("", "first"), ("user", ""), ("user", "b\\b<|im_end|>\n"), ("assistant", "late")],
        2: [("a\nb<|", "x" * 100_000)], 3: [("assistant", "")],
    }
    wanted = [want(c, t) for c, t in talks_of.items()] + [want(None, [("assistant", "alone")])] * 2
    assert [g[:5] for g in got] == sorted(wanted, key=repr)
    assert chat.read_back(chat.examples(empty(talks))).count() == 0


def test_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.05], 1), (4, [1.0, 0.0], 2), (5, [0.0, 0.0], 1), (6, None, 1),
        (7, [1.0, None], 1), (8, [1.0, float("nan")], 1), (9, [1.0, float("inf")], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1),
        (12, [1.0, 0.0], 1), (12, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (13, [-1.0, -0.0], 1), (14, [], 1), (15, [1e-30, 0.0], 1),
    ]
    table = spark.createDataFrame([(*r, "mine") for r in rows], "vec_id long, embedding array<float>, label int, links string")
    got = sorted((tuple(r) for r in vectors.near_duplicates(table).collect()), key=repr)
    near = {1, 2, 3, 12, 15}
    want = []
    for vec_id, *_ in rows:
        linked = vec_id in near
        want.append((vec_id, 5 if linked else 0, 1 if linked else vec_id, vec_id is not None and (vec_id == 1 or not linked)))
    assert got == sorted(want, key=repr)
    assert vectors.near_duplicates(empty(table)).count() == 0


def test_quality(docs, clashing, labels):
    got = quality.scored(clashing, labels).collect()
    assert len(got) == len(HARD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    kept = quality.accepted(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() <= len(HARD)
    assert quality.scored(empty(docs), labels).count() == 0
    assert quality.accepted(docs, empty(labels)).count() == len(HARD)


def test_archive(spark):
    fake = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:77>\r\nContent-Length: 2\r\n\r\nab\r\n\r\nWARC/1.1\r\n"
    rows = [
        (1, "http://a/\r\nX: y", "<p>ü</p>"), (2, None, "<p>ü</p>"), (3, "", None), (4, "u", ""), (5, "u", fake), (6, "u", fake),
        (7, "u", "WARC/1.1\r\n" * 50), (None, "u", "<p>ü</p>"), (8, "u", "y" * 300_000), (8, "u", "y" * 300_000), (None, None, "none"),
        (9, "u", "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n"),
    ]
    pages = spark.createDataFrame([(*r, "mine") for r in rows], "page_id long, url string, html string, payload string")
    for table in (pages.repartition(3), pages.coalesce(1)):
        path = scratch_folder(spark, "test")
        warc.write_archive(table, path)
        got = sorted(
            ((r.page_id, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload).decode()) for r in warc.read_archive(spark, path).collect()),
            key=repr,
        )
        last = {}
        for page_id, _, html in rows:
            last[html or ""] = max(last.get(html or "", -1), -1 if page_id is None else page_id)
        want = []
        for page_id, _, html in rows:
            html, top = html or "", last[html or ""]
            full = top == -1 or page_id == top
            want.append((page_id, "response" if full else "revisit", None if full else top, len(html.encode()), html if full else None))
        assert got == sorted(want, key=repr)
    path = scratch_folder(spark, "test")
    warc.write_archive(empty(pages), path)
    assert warc.read_archive(spark, path).count() == 0
    path = scratch_folder(spark, "test")
    warc.write_archive(pages, path, min_bytes=1000)
    assert warc.read_archive(spark, path).where("record_type = 'revisit'").count() == 0


def test_urls(spark):
    rows = [None, "", "://", "no mark", "HTTP://EXAMPLE.ORG/en/1?x", "http://a.org", "http://a.org?/en", "x://É.COM/de/#", "http://org/", "a://b://c/", "http://casino-pills.test/" + "z" * 100_000]
    pages = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(rows)], "page_id long, url string, rule string")
    got = [tuple(r) for r in urls.judged(pages, RULES).orderBy("page_id").select("host", "path", "rule", "verdict").collect()]
    assert [g[:2] for g in got] == [urls.plain_split(u) for u in rows]
    assert [g[2] for g in got] == [None] * 4 + ["example.org/en/1", None, None, "com/de/", "org/", None, None]
    assert all(g[3] in ("allow", "block") for g in got)
    assert urls.judged(empty(pages), RULES).count() == 0


def test_equally_long_rules(spark):
    """The first listed of two rules of one length decides, in either order."""
    tied = [urls.Rule("block", "a.org", "/xx/"), urls.Rule("allow", "b.a.org", "/x")]
    pages = spark.createDataFrame([(1, "http://b.a.org/xx/y")], "page_id long, url string")
    assert len(tied[0].name) == len(tied[1].name)
    for listed in (tied, tied[::-1]):
        row = urls.judged(pages, listed).first()
        assert (row.rule, row.verdict) == (listed[0].name, listed[0].verdict)


def test_lines(docs, clashing):
    got = lines.deduplicated(clashing)
    assert set(clashing.columns) == set(got.columns)
    texts = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()]
    assert len(texts) == len(HARD)
    words = "alpha beta gamma delta epsilon zeta"
    # a NULL id comes first, so its row keeps the line; equal rows are one document
    assert sorted(t[0] or 0 for t in texts if t[1] == words) == [0]
    assert [t for t in texts if t[0] == 6][0][1:] == ("the long text goes on and on\nends here", 4001, 3999)
    assert [t for t in texts if t[0] == 5][0][1] == HARD[7][1]
    assert {t[1] for t in texts if t[0] == 3} == {None} and {t[1] for t in texts if t[0] == 4} == {""}
    assert lines.deduplicated(empty(docs)).count() == 0


def test_similar_lines(spark):
    base = [f"word{k} other{k * 7 % 13} thing{k * 5 % 11}" for k in range(12)]
    line = " ".join(base)
    rows = [(1, line), (2, line.replace("other7 ", "changed ")), (3, "It, and."), (4, "It and."), (5, "one two three four five"), (6, "one two three four five six")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.deduplicated(table).collect()}
    assert got == brute.deduplicated(rows) and got[2] == ""


def test_simhash(docs, clashing):
    got = simhash.near_duplicates(clashing).collect()
    assert len(got) == len(HARD)
    assert {r.component_id for r in got if r.fp == 0} == {3}
    same = [r.component_id for r in got if r.fp == simhash.fingerprint_of(HARD[0][1])]
    assert same == [1] * 4
    kept = simhash.representatives(clashing)
    ids = sorted(r.doc_id for r in kept.collect())
    assert kept.columns == clashing.columns and ids == [1, 3, 5, 6, 7]
    assert simhash.near_duplicates(empty(docs)).count() == 0 and simhash.representatives(empty(docs)).count() == 0


def test_simhash_in_blocks(spark):
    """Shards larger than a block: every pair of blocks is searched."""
    import random

    rnd = random.Random(4)
    prints = {rnd.getrandbits(20) << 13 for _ in range(300)}
    prints |= {p ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for p in list(prints)[:100]}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), block=16)
    got = {r.node: r.root for r in components(edges).collect()}
    want = brute.groups(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {p: got.get(p, p) for p in signed} == want


def test_mixing(docs, clashing):
    mixed = mixing.replicate(clashing, {"a": 3.0, "b": 0.0})
    assert sorted(mixed.columns) == sorted(clashing.columns)
    got = mixed.collect()
    assert {(r._copies, r._source, r._salt) for r in got} == {("mine",) * 3}
    sizes = {}
    for _, text, _, source, _ in HARD:
        sizes[source] = sizes.get(source, 0) + len(text or "")
    weights = {s: {"a": 3.0, "b": 0.0}.get(s, 1.0) for s in sizes}
    want = {}
    for doc_id, text, _, source, _ in HARD:
        rate = weights[source] * sum(sizes.values()) / (sum(weights.values()) * sizes[source])
        ident = doc_id if doc_id is not None else "null:" + hashlib.md5((text or "").encode()).hexdigest()
        n = brute.copies(ident, rate)
        if n:
            want[(doc_id, text)] = want.get((doc_id, text), 0) + n
    found = {}
    for r in got:
        found[(r.doc_id, r.text)] = found.get((r.doc_id, r.text), 0) + 1
    assert found == want
    assert all(len(r.order_key) == 32 and r.copy >= 1 for r in got)
    assert mixing.replicate(empty(docs), {}).count() == 0


def test_mixing_reaches_targets(spark):
    rows = [(k, "x" * 10, "en", "big" if k % 10 else "small", 10) for k in range(4000)]
    got = mixing.replicate(spark.createDataFrame(rows, DOCS), {"small": 3.0, "big": 1.0})
    share = got.where("source = 'small'").count() / got.count()
    assert abs(share - 0.75) < 0.02 and abs(got.count() - 4000) < 300


def test_personal_data(spark, docs):
    hard = [
        "a@b.c_d@e.f", "x.y@@a.b", "a@b.c.d..e f@g.h", "1.2.3.4.5.6.7.8", "999.1.2.3 1.2.3.4", "4111 1111 1111 1111", "4111  1111 1111 1111 4111-1111-1111-1111",
        "+1 (988) 555-2485", "+1+2 345 678 901 2", "é\U0001f600 a@b.fr ü 10.0.0.1 +49 30 1234567", "", "1" * 5000, "a" * 50_000, "a@b" + ".c" * 20_000, "1.1." * 9000,
        "+" + "1 " * 3000, "a@b.c@d.e", "0000001.2.3.004", "x@y.z-.q", "-@-.-", None, "+1\t234567890",
    ]
    table = spark.createDataFrame([(k, t, "mine") for k, t in enumerate(hard)], "doc_id long, text string, spans string")
    for row in privacy.found(table, support=1).select("doc_id", "base").collect():
        assert [(privacy.KINDS[s.kind], s.start, s.end) for s in row.base] == brute.personal_data(hard[row.doc_id])
    assert privacy.digests(privacy.found(docs)).count() == len(HARD)
    assert privacy.found(empty(docs)).count() == 0


@pytest.mark.parametrize("bound", [privacy.MAX_LITERAL_TERMS, 0])
def test_disclosing_terms(spark, monkeypatch, bound):
    monkeypatch.setattr(privacy, "MAX_LITERAL_TERMS", bound)
    told = [(k, f"Invoice for user{k}@mail.org from the desk", "x") for k in range(20)]
    other = [(100 + k, "the weather on the desk was Fine", "x") for k in range(60)] + [(200, "an invoice came", "x")]
    table = spark.createDataFrame(told + other, "doc_id long, text string, base string")
    got = {r.doc_id: r for r in privacy.found(table).collect()}
    assert "Invoice" not in got[0].sanitised and "mail.org" not in got[0].sanitised
    assert got[100].sanitised == other[0][1] and "invoice" not in got[200].sanitised
    assert [s.kind for s in got[200].spans] == [len(privacy.KINDS)]
    assert (got[200].spans[0].start, got[200].spans[0].end) == (3, 10)


def test_decontamination(spark, docs, clashing):
    item = "what is the name of the seventh planet counted from the sun? it is the ice giant uranus"
    rows = [(1, item), (2, None), (3, ""), (4, "?!"), (1, item), (5, "goes on")]
    items = spark.createDataFrame([(*r, "mine") for r in rows], "item_id long, text string, doc_id string")
    held = clashing.where("doc_id = 4").withColumn("text", F.lit(("pad " * 3000) + item.upper() + (" pad" * 50)))
    got = decontaminate.contaminated(clashing.unionByName(held), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(4, 1), (6, 5)}
    clean = decontaminate.clean(clashing, items)
    assert clean.columns == clashing.columns and clean.count() == len(HARD) - 1
    assert decontaminate.contaminated(empty(docs), items).count() == 0
    assert decontaminate.clean(docs, empty(items)).count() == len(HARD)


def test_an_item_without_its_answer_is_none(spark):
    question = " ".join(f"question{k}" for k in range(31)) + "? "
    items = [(1, question + "the answer has six plain words"), (2, "an item of one sentence with several words in it")]
    texts = [(1, question + "nothing of the kind follows here at all"), (2, "pad " * 50 + items[0][1] + " pad" * 50), (3, items[1][1])]
    texts.append((4, "the answer has six plain words alone"))
    docs, tests = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {(d, i) for d, text in texts for i, item in items if brute.holds_item(text, item)}
    assert want == {(2, 1), (3, 2)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, tests).collect()} == want


@pytest.mark.parametrize("bounds", [{"max_items": 3}, {"max_bytes": 300}])
def test_a_test_set_beyond_the_bound_of_one_index(spark, bounds):
    items = [(k, " ".join(f"w{k}x{j}" for j in range(12)) + ". " + f"a{k} b{k} c{k}") for k in range(20)] + [(None, "one two three four five six seven")]
    texts = [(k, f"before {text} behind {items[(k + 1) % 20][1]}") for k, (_, text) in enumerate(items)] + [(50, "clean"), (51, None)]
    docs, tests = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert len(list(decontaminate.load_indexes(tests, **bounds))) > 3
    found = lambda **b: {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, tests, **b).collect()}
    assert found(**bounds) == found() and len(found()) == 42
    assert {r.doc_id for r in decontaminate.clean(docs, tests, **bounds).collect()} == {50, 51}


def test_very_long_lines_that_are_near(spark):
    """Longer than a piece of shingles, and many long ones in one bucket."""
    import random

    rnd = random.Random(9)
    line = "".join(rnd.choice("abcdefghij klmno") for _ in range(400_000))
    rows = [(1, line), (2, line[:200_000] + "changed" + line[200_000:]), (3, line[::-1]), (4, line[:250_000])]
    rows += [(10 + k, line[:300_000] + str(k) * 20_000) for k in range(8)]
    got = {r.doc_id: bool(r.text) for r in lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {k: bool(t) for k, t in brute.deduplicated(rows).items()}
    assert got == want and sum(want.values()) < len(rows)
