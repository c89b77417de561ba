"""Line deduplication with a shingle at every character."""

from __future__ import annotations

import random

from tests.llm import brute
from tidemark.llm import lines, shingles

APART = [
    "https://example.org/news/2024/05/17/a-long-title",
    "https://example.org/about/contact",
    "id: 123456789012345",
    "id: 123456789098765",
    "一二三四五六七八九十甲乙丙丁戊己庚辛壬癸",
    "一二三四五六七八九十子丑寅卯辰巳午未申酉",
    "\U0001f600" * 12 + "tail",
    "short",
    "short.",
]


def deduplicated(spark, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: r.text for r in lines.deduplicated(table).collect()}


def test_lines_that_differ_behind_the_tenth_character_of_a_word_stay(spark):
    docs = list(enumerate(APART))
    assert deduplicated(spark, docs) == dict(docs) == brute.deduplicated(docs, brute.sliding_shingles)


def test_lines_without_blanks_against_brute_force(spark):
    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcdefgh/é漢") for _ in range(rnd.randint(40, 200))) for _ in range(30)]
    near = [b[:20] + "X" + b[21:] for b in base] + [b + "tail" for b in base] + [b[:12] + b[:5:-1] for b in base]
    docs = list(enumerate(base + near))
    want = brute.deduplicated(docs, brute.sliding_shingles)
    got = deduplicated(spark, docs)
    # banding may miss a pair just above the threshold
    assert sum(got[k] != want[k] for k in want) <= 1 and 0 < sum(not t for t in want.values()) < len(docs) - 30


def test_no_near_pair_of_short_lines_is_left_to_chance(spark):
    """Sets of 4 and 5 shingles, of 9 that differ in one, of 9 and 10."""
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    docs = []
    for k in range(0, 3000, 6):
        five, nine = word(14), word(18)
        docs += [(k, five), (k + 1, five[:-1]), (k + 2, nine), (k + 3, nine[1:] + word(1)), (k + 4, ten := word(19)), (k + 5, ten[1:])]
    got = deduplicated(spark, docs)
    assert [k for k, text in got.items() if bool(text) != (k % 2 == 0)] == []


def test_recall_of_the_bands_just_above_the_threshold():
    rnd, letters, pairs = random.Random(1), "abcdefghijklmnopqrstuvwxyz   ", []
    while len(pairs) < 2000:
        one = [rnd.choice(letters) for _ in range(rnd.randint(25, 400))]
        two = one[:]
        for _ in range(rnd.randint(1, max(1, len(one) // 70))):
            two[rnd.randrange(len(two))] = rnd.choice(letters)
        x, y = brute.sliding_shingles("".join(one)), brute.sliding_shingles("".join(two))
        if 0.8 <= len(x & y) / len(x | y) <= 0.85:
            pairs.append(("".join(one), "".join(two)))

    def keys(texts):
        return [set(k.tolist()) for a, b in shingles.groups(texts) for k in lines._signed(texts[a:b], 0.8)[2]]

    met = [bool(a & b) for a, b in zip(*(keys(list(side)) for side in zip(*pairs, strict=True)), strict=True)]
    assert sum(met) >= 0.98 * len(pairs)


def test_only_lines_that_share_a_bucket_carry_their_text(spark, monkeypatch):
    rnd, carried, near = random.Random(8), [], lines._near
    alone = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(80)) for _ in range(200)]

    def noted(pairs, texts, threshold):
        carried.append({r.line for r in texts.collect()})
        return near(pairs, texts, threshold)

    monkeypatch.setattr(lines, "_near", noted)
    got = deduplicated(spark, [*enumerate(alone), (200, alone[0] + "x")])
    assert [k for k, text in got.items() if not text] == [200]
    assert {alone[0], alone[0] + "x"} <= carried[0] and len(carried[0]) < 20
