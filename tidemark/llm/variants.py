"""Spelling variants: words one edit apart, found with sorted permuterm rotations.

A word with a terminator behind it has one rotation per character. The rotation that ends with the
edited character puts all others before it: words that differ by that one replacement share
everything but the last character of theirs, and a word that lacks the character is that shared
part itself, as a whole rotation of its own. So every word is entered under each of its
rotations (as the word that lacks something) and under each rotation less its last character (as
a word with that character). The entries are sorted over the cluster by range and scanned; an
equal stretch holds at most one word that lacks the character and one word per letter, so it is as
short as the alphabet. A pair meets once: of equal characters in a row only the first counts as the one
lacking. The scan adds up, per word, the number of neighbours and the best of them; no list of
pairs is made.

The text is cut and counted per task before the counts meet by word. ``root`` follows the
forms by pointer jumping; a form has at least ``ratio`` times the occurrences, so chains
are as short as the logarithm of the largest count.

Rows: a NULL text has no words, a NULL id counts as an empty one in the hash that drops a character.
Repeated rows count each. A very long text is one row of its task, its words are counted as it is read. Among
near words of equal count the smallest in code-point order is the form. No words give an empty
result. Only the two named columns are read, so extra columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Runs of Latin letters in lower-cased UTF-8: a to z, and U+00C0 to U+00FF (C3 80 to C3 BF).
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
END = "$"
SLIP = 199
HELD = 200_000
ROTATIONS_PER_TASK = 500_000
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5


def slipped(run: bytes, h: int) -> str:
    """``run`` less one character where ``SLIP`` divides the hash ``h`` of its place."""
    word = run.decode()
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``(word, n)``: the words of at least ``least_length`` characters and ``least_count`` occurrences."""

    def table(counts: Counter) -> pa.RecordBatch:
        words = [w for w in counts if len(w) >= least_length]
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], ["word", "n"]
        )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text"), strict=True):
                start = crc32(name + b":")
                for run, n in Counter(RUN.findall(text.as_py().lower())).items():
                    counts[slipped(run, crc32(run, start))] += n
                if len(counts) > HELD:
                    yield table(counts)
                    counts.clear()
        yield table(counts)

    name = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary").alias("name")
    texts = docs.select(name, F.col(text_col).cast("string").cast("binary").alias("text")).where(F.col("text").isNotNull())
    partial = texts.mapInArrow(counted, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``(key, lacks, counts, word, n)``: each rotation of each word, whole and less its last character.

    ``lacks``: the key is a whole rotation. ``counts``: the character left out is not the same as
    the one before it in the word.
    """
    spot, length = F.col("spot"), F.char_length("word")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("spot"))
    head = F.substring("word", F.lit(1), spot)
    whole = turned.select(
        F.concat(F.substring("word", spot + 1, length), F.lit(END), head).alias("key"),
        F.lit(True).alias("lacks"), F.lit(True).alias("counts"), "word", "n",
    )
    repeats = (spot > 0) & (F.substring("word", spot, F.lit(1)) == F.substring("word", spot + 1, F.lit(1)))
    short = turned.where(spot < length).select(
        F.concat(F.substring("word", spot + 2, length), F.lit(END), head).alias("key"),
        F.lit(False).alias("lacks"), (~repeats).alias("counts"), "word", "n",
    )
    return whole.unionByName(short)


def _better(a: tuple[str, int] | None, b: tuple[str, int] | None) -> tuple[str, int] | None:
    """The word of larger count, then the smaller word."""
    if a is None or b is None:
        return a or b
    return min(a, b, key=lambda w: (-w[1], w[0]))


def _stretch(rows: list[tuple]) -> Iterator[tuple]:
    """``(word, near, best, best_n)`` for the words ``(lacks, counts, word, n)`` of one key.

    The word that lacks the character comes first, the others by falling count, then by word.
    """
    lacking = (rows[0][2], rows[0][3]) if rows[0][0] else None
    others = rows[1:] if lacking else rows
    if lacking:
        longer = [r for r in others if r[1]]
        if longer:
            yield lacking[0], len(longer), longer[0][2], longer[0][3]
    for place, (_, counts, word, _) in enumerate(others):
        rival = None
        if len(others) > 1:
            rival = others[1 if place == 0 else 0][2:4]
        shorter = lacking if counts else None
        best = _better(rival, shorter)
        if best:
            yield word, len(others) - 1 + (shorter is not None), *best


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries to what each equal stretch tells its words; the last stretch waits for the next batch."""
    names = ["word", "near", "best", "best_n"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    waiting = None

    def told(part: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        ends = np.append(starts[1:], part.num_rows)
        columns = [part.column(c) for c in ("lacks", "counts", "word", "n")]
        out: list[tuple] = []
        # an entry alone in its stretch has no neighbour there
        many = ends - starts > 1
        chosen = pa.array(np.repeat(many, ends - starts))
        rows = list(zip(*[c.filter(chosen).to_pylist() for c in columns], strict=True))
        at = 0
        for size in (ends - starts)[many].tolist():
            out.extend(_stretch(rows[at : at + size]))
            at += size
        lists = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(lists, kinds, strict=True)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        if waiting is not None:
            part = pa.concat_tables([waiting, part]).combine_chunks()
        keys = part.column("key").combine_chunks()
        change = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        starts = np.concatenate(([0], np.flatnonzero(change) + 1))
        waiting = part.slice(int(starts[-1]))
        if len(starts) > 1:
            yield told(part.slice(0, int(starts[-1])), starts[:-1])
    if waiting is not None:
        yield told(waiting, np.array([0]))


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` of each word with a near one; ``best`` is ``(less, word)``, ``less`` its count negated."""
    total = words.agg(F.sum(2 * F.char_length("word") + 1)).first()[0] or 0
    tasks = -(-total // ROTATIONS_PER_TASK) or 1
    in_order = rotations(words).repartitionByRange(tasks, "key").sortWithinPartitions("key", F.desc("lacks"), F.desc("n"), "word")
    found = in_order.mapInArrow(_scanned, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)``: where the chain of ``links(word, form)`` ends. Each round halves what is left of a chain."""
    current = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = current.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        jumped = current.join(further, F.col("root") == F.col("_at"), "left")
        if jumped.where(F.col("_next").isNotNull()).isEmpty():
            return current
        current = stored(jumped.select("word", F.coalesce("_next", "root").alias("root")), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO) -> DataFrame:
    """A row per word: its near words, the far more frequent one it is a form of, and where the forms lead."""
    words = stored(word_counts(docs, id_col, text_col), "words")
    near = neighbours(words)
    judged = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= ratio * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    judged = stored(judged, "judged")
    ends = roots(judged.where(F.col("form").isNotNull()))
    rooted = judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
