"""Benchmark decontamination: a BM25 index of test items, asked with every passage of a corpus.

The index holds test items only. Its size is checked: a test set beyond the bound is dealt by
``item_id`` to several indexes, and the corpus is asked once for each. An index travels to the
tasks with the function; a training text is cut into overlapping word windows, each longer
than an item by the step between two windows, so every occurrence lies whole in some window.
A window retrieves all items whose BM25 score reaches the item's threshold (block-max WAND),
and a retrieved item counts when enough of its five-word shingles stand in the window: of the
whole item, of its question and of its answer. The answer is the last sentence or line; an item of
one sentence or line is question and answer at once, so the whole decides.

An item's threshold is the least score that a window with the required share of its shingles can
have: the item's own score less the largest word weights that the missing shingles may cost. So
retrieval loses nothing that verification would accept.

Rows: a NULL or wordless text or item matches nothing. Repeated rows each give their matches.
Of equal ``item_id`` each row is a test item of its own; a row of matches is kept once per
(row of docs, item_id), the best overlap first. Empty tables give an empty result. Extra columns are
carried along, whatever their names. Texts of any length are asked whole. With several indexes a
score is that of the item's own index; which items match does not depend on their number.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free, stored
from tidemark.llm.quality import _slices

#: ASCII bytes other than letters and digits part words; all others belong to them.
PARTING = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
K1, B = 1.2, 0.75
SHINGLE, SHARE = 5, 0.8


@dataclass
class Item:
    item_id: int | None
    words: list[bytes]
    weights: dict[bytes, float] = field(default_factory=dict)
    floor: float = 0.0
    low_mass: float = 0.0
    parts: tuple[frozenset, frozenset] = (frozenset(), frozenset())


@dataclass
class Index:
    """``postings[word]``: parallel arrays of item numbers and weights, weights over the item's floor."""

    items: list[Item]
    postings: dict[bytes, tuple[np.ndarray, np.ndarray]]
    block_max: dict[bytes, np.ndarray]
    block: int
    numbers: dict[bytes, int]
    rare_start: np.ndarray
    rare_item: np.ndarray
    rare_weight: np.ndarray
    low_mass: np.ndarray
    longest: int

    @property
    def unguarded(self) -> bool:
        """Whether some item can be reached by common words alone; then every window is asked."""
        return bool(len(self.low_mass)) and self.low_mass.max() >= 1 - 1e-9


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(PARTING).split()


def shingles(words: list[bytes]) -> frozenset:
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1)))


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The last sentence or line is the answer; the rest, or all if it stands alone, the question."""
    pieces = [w for w in map(words_of, re.split(r"[.?!]\s|\n", text)) if w]
    if len(pieces) < 2:
        return words_of(text), words_of(text)
    return [w for piece in pieces[:-1] for w in piece], pieces[-1]


def build_index(rows: list[tuple[int | None, str | None]], block: int = 16, common: float = 0.02) -> Index:
    """``common``: words in more than this share of items (and in over two) are non-essential lists."""
    items = [Item(i, w, parts=tuple(map(shingles, question_and_answer(t)))) for i, t in rows if (w := words_of(t))]
    seen = Counter(w for item in items for w in set(item.words))
    mean = sum(len(i.words) for i in items) / max(1, len(items))
    limit = max(2, common * len(items))
    postings: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
    for number, item in enumerate(items):
        scale = K1 * (1 - B + B * len(item.words) / mean)
        for word, tf in Counter(item.words).items():
            idf = math.log(1 + (len(items) - seen[word] + 0.5) / (seen[word] + 0.5))
            item.weights[word] = idf * tf * (K1 + 1) / (tf + scale)
        total = max(1, len(item.words) - SHINGLE + 1)
        spared = sorted(item.weights.values(), reverse=True)[: total - math.ceil(SHARE * total)]
        item.floor = (sum(item.weights.values()) - sum(spared)) * (1 - 1e-9)
        item.low_mass = sum(x for w, x in item.weights.items() if seen[w] > limit) / item.floor
        for word, weight in item.weights.items():
            postings[word].append((number, weight / item.floor))
    arrays = {w: (np.array([n for n, _ in p]), np.array([x for _, x in p])) for w, p in postings.items()}
    tops = {}
    for word, (numbers, weights) in arrays.items():
        top = np.zeros(len(items) // block + 1)
        np.maximum.at(top, numbers // block, weights)
        tops[word] = top
    # the lists of rare words one after the other: only these are expanded to find candidates
    rare = {w: lists for w, lists in arrays.items() if seen[w] <= limit}
    names = {w: k for k, w in enumerate(rare)}
    starts = np.concatenate(([0], np.cumsum([len(n) for n, _ in rare.values()]))).astype(np.int64)
    flat = lambda k, kind: np.concatenate([r[k] for r in rare.values()]).astype(kind) if rare else np.zeros(0, kind)
    return Index(items, arrays, tops, block, names, starts, flat(0, np.int64), flat(1, float), np.array([i.low_mass for i in items]), max([len(i.words) for i in items], default=0))


def block_max_wand(index: Index, words: set[bytes], floor: float = 1.0) -> list[tuple[int, float]]:
    """All items whose summed weights over ``words`` reach ``floor``.

    Lists are kept in order of their current item. The pivot is the first list at which the
    lists' maxima could add up to the floor; if the block maxima around the pivot cannot, the
    whole block is skipped, else the item is scored in full.
    """
    lists = [(w, *index.postings[w], index.block_max[w]) for w in words if w in index.postings]
    tops = {w: m.max() for w, _, _, m in lists}
    at = [[int(n[0]), 0, w, n, x, m] for w, n, x, m in lists]
    found = []
    while True:
        at = [e for e in at if e[1] < len(e[3])]
        at.sort(key=lambda e: e[0])
        reach, pivot = 0.0, None
        for entry in at:
            reach += tops[entry[2]]
            if reach >= floor:
                pivot = entry[0]
                break
        if pivot is None:
            return found
        upto = [e for e in at if e[0] <= pivot]
        number = pivot // index.block
        if sum(e[5][number] for e in upto) < floor:
            following = min([(number + 1) * index.block, *[e[0] for e in at if e[0] > pivot]])
            aim = max(following, pivot + 1)
        elif at[0][0] == pivot:
            score = sum(e[4][e[1]] for e in upto)
            if score >= floor:
                found.append((pivot, float(score)))
            aim = pivot + 1
        else:
            aim = pivot
        for e in upto:
            if e[0] < aim:
                e[1] = int(np.searchsorted(e[3], aim))
                if e[1] < len(e[3]):
                    e[0] = int(e[3][e[1]])


def _candidate_windows(index: Index, words: list[bytes]) -> np.ndarray:
    """First words of the windows that may hold an item, by the lists' upper bounds.

    An item within reach needs ``1`` from its weights; what its common words can give at most is
    known, so the rare ones must give the rest. Rare weights are summed per window and item.
    """
    step = index.longest
    if index.unguarded:
        return np.arange((len(words) - 1) // step + 1) * step
    rare = index.numbers
    found = [k for k, word in enumerate(words) if word in rare]
    if not found:
        return np.zeros(0, np.int64)
    place, known = np.array(found), np.array([rare[words[k]] for k in found])
    first = index.rare_start[known]
    count = index.rare_start[known + 1] - first
    total, free = int(count.sum()), index.low_mass
    spread = np.repeat(first - np.cumsum(count) + count, count) + np.arange(total)
    where, item, weight = np.repeat(place // step, count), index.rare_item[spread], index.rare_weight[spread]
    # a window covers two steps: its own and the next
    keys = np.concatenate((where, where - 1)) * len(index.items) + np.tile(item, 2)
    sums_of, back = np.unique(keys, return_inverse=True)
    sums = np.bincount(back, np.tile(weight, 2))
    hit = sums_of[sums + free[sums_of % len(index.items)] >= 1 - 1e-9] // len(index.items)
    return np.unique(np.clip(hit, 0, None)) * step


def matches_of(index: Index, text: str | None) -> list[tuple[int | None, float, float, float]]:
    """``(item_id, score, question overlap, answer overlap)`` of the items that a text holds."""
    words = words_of(text)
    best: dict[int | None, tuple] = {}
    if not words or not index.items:
        return []
    for start in _candidate_windows(index, words).tolist():
        window = words[start : start + 2 * index.longest]
        held = None
        for number, score in block_max_wand(index, set(window)):
            item = index.items[number]
            if held is None:
                held = shingles(window)
                short = {tuple(window[k : k + n]) for n in range(1, SHINGLE) for k in range(len(window) - n + 1)}
            whole = shingles(item.words)
            share = lambda part: sum(s in held or s in short for s in part) / len(part)  # noqa: B023, E731
            asked, answered = map(share, item.parts)
            if share(whole) >= SHARE and asked >= SHARE and answered >= SHARE:
                row = (item.item_id, score, asked, answered)
                if item.item_id not in best or best[item.item_id][2:] < row[2:]:
                    best[item.item_id] = row
    return sorted(best.values(), key=lambda r: (r[0] is None, r[0] or 0))


def load_indexes(benchmark: DataFrame, max_items: int = 200_000, max_bytes: int = 64 << 20) -> Iterator[Index]:
    """Indexes of a test set, one after the other, each of about ``max_items`` or ``max_bytes`` at most.

    Rows of one ``item_id`` are in one index. There is at least one, if need be an empty one.
    """
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    items, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-items // max_items), -(-size // max_bytes))
    for part in range(parts):
        found = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()
        yield build_index(sorted(map(tuple, found), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))


MATCH = "array<struct<item_id:bigint,score:double,question_overlap:double,answer_overlap:double>>"


def with_matches(docs: DataFrame, index: Index, text_col: str = "text", name: str = "_matches") -> DataFrame:
    """``docs`` with ``name``: the test items each text holds."""
    spark, place = docs.sparkSession, docs.columns.index(text_col)
    schema = docs.select("*", F.lit(None).cast(MATCH).alias(name)).schema
    # one copy of the index per executor, not one per task; load_indexes has bounded its size
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(index))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))
    names = [f.name for f in kind.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = cloudpickle.loads(shared.value)
        for whole in batches:
            for batch in _slices(whole, place):
                found = [[dict(zip(names, m, strict=True)) for m in matches_of(here, t)] for t in batch.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, **bounds: int) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)``: a row per text and item in it.

    ``bounds`` are those of ``load_indexes``.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = None
    for index in load_indexes(benchmark, **bounds):
        hits = with_matches(texts, index).select("doc_id", F.explode("_matches").alias("_")).select("doc_id", "_.*")
        # what was found before is stored, so that one index is in use at a time
        found = hits if found is None else stored(found, "matches").unionByName(hits)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    name, kept = free(docs, "_matches")[0], None
    for index in load_indexes(benchmark, **bounds):
        asked = docs if kept is None else stored(kept, "clean")
        kept = with_matches(asked, index, name=name).where(F.size(name) == 0).drop(name)
    return kept
