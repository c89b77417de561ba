"""Exact repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``size`` bytes that also starts anywhere else is taken out; strings lie
within one document. The method has three steps, each of which works on what the one before
could not tell:

* **Parse.** A rolling hash of ``WINDOW`` bytes triggers where it falls below a bound, and phrases run
  from trigger to trigger. Equal text has equal triggers, so a window of ``size`` bytes is told by its first
  trigger: the *phrase suffix* before it and the *rest of the parse* behind it. Windows of one phrase that
  are about as far from their trigger form a block, which stands for all of them. Windows without a
  trigger are parsed by a second, more frequent one; a window without that is a block of its own.
* **Dictionary.** Blocks are named by a digest of all bytes of their windows and counted, but only
  those whose rest of the parse (as far as all windows of the block reach) occurs again; in text
  that does not repeat none does. A block that occurs twice repeats as a whole, with no look at
  its bytes: so do long copies, however many there are.
* **Corpus order.** What is left are blocks that occur once while others share their rest of the parse: the
  two ends of a repeated passage. Each of their windows is entered under (rest of the parse, phrase
  suffix, last bytes) together with the windows of the dictionary blocks they may equal, once per name,
  and the entries are sorted over the cluster, by range. Equal windows are neighbours. A frequent window does not meet in
  one task: entries are split by position too, and the ends of the sorted slices are compared at the end.

Phrases are ordered by name rather than by their letters: only equal neighbours matter here. Names are 128-bit
digests. The work of a task is bounded by the text of its documents and by equal shares of the sorted entries.

Rows: a NULL text is empty. A text shorter than ``size`` loses nothing. Rows that repeat id and text are
two documents, so each of their windows occurs twice. A NULL id is a value like others. Text without any trigger (as a run
of one byte) gives a block per byte. A very long text is hashed in pieces, one row of its task. An empty table gives an
empty result. Only the two named columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SIZE = 400
WINDOW = 8
MIX = np.uint64(0x9E3779B97F4A7C15)
#: One window in so many triggers; the second is asked where the first leaves whole windows without one.
PHRASES = (48, 6)
#: Distances to the trigger at which the blocks of a phrase are cut.
CUTS = (0, 64, 128, 256)
#: Bands of both kinds of trigger, then the windows without any.
ALONE = 2 * len(CUTS)
PIECE, HELD = 1 << 22, 50_000
ENTRIES_PER_TASK = 200_000
UNIT = ["doc_id", "digest"]
#: Bits of a distance in a packed spot; a window is shorter than that many bytes.
BITS = 14

Spot = tuple[int, int, int, int]


def triggers(data: bytes, phrase: int) -> list[int]:
    """Where the hash of the next ``WINDOW`` bytes is in the lowest ``phrase``-th."""
    found, bound = [], np.uint64((1 << 64) // phrase)
    for start in range(0, len(data) - WINDOW + 1, PIECE):
        count = min(PIECE, len(data) - WINDOW + 1 - start)
        words = np.ndarray((count,), "<u8", data, start, (1,)).copy()
        found.extend((np.flatnonzero(words * MIX < bound) + start).tolist())
    return found


def _bands(size: int) -> list[tuple[int, int]]:
    """Distances ``[a, b)`` of a window's start to its first trigger, which must lie in the window."""
    cuts = [c for c in CUTS if c <= size - WINDOW] + [size - WINDOW + 1]
    return list(zip(cuts, cuts[1:], strict=False))


def _cut(found: list[int], first: int, last: int, bands: list[tuple[int, int]], level: int) -> tuple[list[Spot], list[tuple[int, int]]]:
    """Blocks of the starts from ``first`` to ``last`` by the triggers ``found``; runs of starts without one."""
    spots, bare, before, beyond = [], [], first - 1, bands[-1][1]
    for at in found:
        if before >= last:
            break
        reach, least = at - before - 1, max(0, at - last)
        for band, (a, b) in enumerate(bands):
            if a > reach:
                break
            near, far = max(a, least), min(b - 1, reach)
            if near <= far:
                spots.append((level * len(CUTS) + band, at, far, near))
        if reach >= beyond:
            bare.append((before + 1, min(at - beyond, last)))
        before = at
    if before < last:
        bare.append((before + 1, last))
    return spots, bare


def blocks_of(data: bytes, size: int) -> list[Spot]:
    """``(band, at, far, near)``: the windows that start ``far`` down to ``near`` bytes before ``at``.

    Each start of a window is in one block. Where whole windows have no trigger, as in text of a
    short period, more frequent triggers cut them; where those are missing too every window is a block.
    """
    last, bands = len(data) - size, _bands(size)
    if last < 0:
        return []
    spots, bare = _cut(triggers(data, PHRASES[0]), 0, last, bands, 0)
    for first, stop in bare:
        finer = [first + t for t in triggers(data[first : stop + size], PHRASES[1])]
        more, none = _cut(finer, first, stop, bands, 1)
        spots += more
        spots += [(ALONE, start, 0, 0) for a, b in none for start in range(a, b + 1)]
    return spots


def _rest(data: bytes, band: int, at: int, size: int, bands: list[tuple[int, int]]) -> bytes:
    """The bytes from the trigger on that all windows of a block have; all bytes of a window alone."""
    return data[at : at + (size if band == ALONE else size - bands[band % len(CUTS)][1] + 1)]


def _packed(spots: list[Spot]) -> np.ndarray:
    band, at, far, near = np.array(spots, np.int64).reshape(-1, 4).T
    return ((at << 4 | band) << BITS | far) << BITS | near


def _unpacked(spot: int) -> Spot:
    low = (1 << BITS) - 1
    return spot >> 2 * BITS & 15, spot >> 2 * BITS + 4, spot >> BITS & low, spot & low


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), text.cast("binary").alias("data"))


def rests(texts: DataFrame, size: int) -> DataFrame:
    """``(rest)`` of every block: the digest of the parse behind it."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, short = _bands(size), xxhash.xxh3_64_intdigest
        for batch in batches:
            for value in batch.column("data"):
                data = value.as_py()
                found = [short(_rest(data, band, at, size, bands), band) for band, at, _, _ in blocks_of(data, size)]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(found, np.uint64).view(np.int64))], ["rest"])

    return texts.where(F.octet_length("data") >= size).select("data").mapInArrow(parse, "rest long")


def parsed(texts: DataFrame, size: int) -> DataFrame:
    """``(rest, name, doc_id, digest, spot)`` of every block; with ``rest``, ``name`` tells all bytes of it."""
    fields = ["rest", "name", *UNIT, "spot"]
    kind = texts.schema["doc_id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, digest = _bands(size), xxhash.xxh3_64_intdigest
        for batch in batches:
            behind: list[int] = []
            names: list[int] = []
            spots: list[Spot] = []
            rows: list[int] = []

            def flush(batch=batch, held=(behind, names, spots, rows)) -> pa.RecordBatch:
                owner = pa.array(held[3], pa.int64())
                columns = [
                    *[pa.array(np.array(h, np.uint64).view(np.int64)) for h in held[:2]],
                    *[batch.column(u).take(owner) for u in UNIT], pa.array(_packed(held[2])),
                ]
                for h in held:
                    h.clear()
                return pa.RecordBatch.from_arrays(columns, fields)

            for row, value in enumerate(batch.column("data")):
                data = value.as_py()
                for spot in blocks_of(data, size):
                    band, at, far, near = spot
                    behind.append(digest(_rest(data, band, at, size, bands), band))
                    names.append(digest(data[at - far : at - near + size], far << BITS | near))
                    spots.append(spot)
                    rows.append(row)
                    if len(rows) >= HELD:
                        yield flush()
            if rows:
                yield flush()

    blocks = texts.where(F.octet_length("data") >= size)
    return blocks.mapInArrow(parse, f"rest long, name long, doc_id {kind}, digest long, spot long")


def _windows(texts: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """``(key, times, doc_id, digest, start)``: every window of ``blocks``, by its place in corpus order."""
    spot = F.struct("times", "spot")
    wanted = blocks.groupBy(*UNIT).agg(F.collect_list(spot).alias("spots")).withColumnsRenamed({u: f"_{u}" for u in UNIT})
    same = texts["doc_id"].eqNullSafe(wanted["_doc_id"]) & (texts["digest"] == wanted["_digest"])
    joined = texts.join(wanted, same).select(*UNIT, "data", "spots")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = _bands(size)
        names = ["key", "times", *UNIT, "start"]

        def made(row: dict, keys: list[bytes], times: list[int], starts: list[int], kind: pa.DataType) -> pa.RecordBatch:
            owner = [pa.array([row[u]] * len(keys), t) for u, t in zip(UNIT, (kind, pa.int64()), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(times, pa.int64()), *owner, pa.array(starts, pa.int32())], names
            )

        for batch in batches:
            of_id = batch.schema.field("doc_id").type
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                data, keys, times, starts = row["data"], [], [], []
                for s in row["spots"]:
                    band, at, most, least = _unpacked(s["spot"])
                    rest = _rest(data, band, at, size, bands)
                    head, end = bytes([band]) + xxhash.xxh3_128_digest(rest), at + len(rest)
                    for far in range(least, most + 1):
                        start = at - far
                        keys.append(head + far.to_bytes(2, "big") + data[start:at] + data[end : start + size])
                        times.append(s["times"])
                        starts.append(start)
                    if len(keys) >= HELD:
                        yield made(row, keys, times, starts, of_id)
                        keys, times, starts = [], [], []
                if keys:
                    yield made(row, keys, times, starts, of_id)

    return joined.mapInArrow(cut, f"key binary, times long, doc_id {kind}, digest long, start int")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted windows to those that equal a neighbour, and the first and last of the slice with their key."""
    slice_id = TaskContext.get().partitionId()
    held: pa.RecordBatch | None = None
    before: bytes | None = None

    def told(batch: pa.RecordBatch, after: bytes | None) -> pa.RecordBatch:
        keys = batch.column("key")
        same = pc.equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        first, last = np.zeros(1, bool), np.zeros(1, bool)
        first[0] = before is not None and keys[0].as_py() == before
        last[0] = after is not None and keys[-1].as_py() == after
        met = np.concatenate((first, same)) | np.concatenate((same, last))
        edge = np.zeros(len(met), bool)
        edge[0] |= before is None
        edge[-1] |= after is None
        once = batch.column("times").to_numpy() == 1
        chosen = pa.array(np.flatnonzero(edge | (met & once)))
        shown = pc.if_else(pa.array(edge), keys, pa.scalar(None, pa.binary()))
        columns = [shown, batch.column("times"), *[batch.column(u) for u in UNIT], batch.column("start"), pa.array(met)]
        columns = [c.take(chosen) for c in columns] + [pa.array(np.full(len(chosen), slice_id, np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["key", "times", *UNIT, "start", "met", "slice"])

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield told(held, batch.column("key")[0].as_py())
            before = held.column("key")[-1].as_py()
        held = batch
    if held is not None:
        yield told(held, None)


def _repeated(windows: DataFrame) -> DataFrame:
    """``(doc_id, digest, start)`` of the windows of once-named blocks that equal another one."""
    windows = stored(windows, "windows")
    tasks = -(-windows.count() // ENTRIES_PER_TASK) or 1
    place = ["key", *UNIT, "start"]
    in_order = windows.repartitionByRange(tasks, *place).sortWithinPartitions(*place)
    kind = windows.schema["doc_id"].dataType.simpleString()
    schema = f"key binary, times long, doc_id {kind}, digest long, start int, met boolean, slice int"
    scanned = stored(in_order.mapInArrow(_neighbours, schema), "scanned")
    inside = scanned.where("met AND times = 1")
    # two rows per slice: a key at the ends of two slices runs across their border
    edges = scanned.where("key IS NOT NULL")
    across = edges.groupBy("key").agg(F.count_distinct("slice").alias("slices")).where("slices > 1").select("key")
    border = edges.where("times = 1").join(across, "key", "left_semi")
    return inside.select(*UNIT, "start").unionByName(border.select(*UNIT, "start"))


def repeats(texts: DataFrame, size: int) -> DataFrame:
    """``(doc_id, digest, spans)``: the bytes of each document that repeat, as overlapping ``(start, stop)``."""
    again = rests(texts, size).groupBy("rest").agg(F.count("*").alias("times")).where("times > 1").select("rest")
    # stored, so that the join reads two plain shuffles, whose hot keys adaptive execution splits
    again = stored(again, "again")
    met = stored(parsed(texts, size).join(again, "rest"), "met")

    name = ["rest", "name"]
    # where a block occurs once, the first is the one; else any will do
    spot = [F.first(c).alias(c) for c in (*UNIT, "spot")]
    names = stored(met.groupBy(*name).agg(F.count("*").alias("times"), *spot), "names")
    whole = met.join(names.where("times > 1").select(*name), name, "left_semi")
    low = (1 << BITS) - 1
    at, far, near = F.shiftright("spot", 2 * BITS + 4), F.shiftright("spot", BITS).bitwiseAND(low), F.col("spot").bitwiseAND(low)
    found = whole.select(*UNIT, (at - far).cast("int").alias("start"), (at - near + size).cast("int").alias("stop"))

    mixed = names.groupBy("rest").agg(F.count("*").alias("kinds"), F.min("times").alias("least"))
    mixed = mixed.where("kinds > 1 AND least = 1").select("rest")
    ends = names.join(mixed, "rest", "left_semi").select("times", *UNIT, "spot")
    single = _repeated(_windows(texts, ends, size))
    found = found.unionByName(single.select(*UNIT, "start", (F.col("start") + size).alias("stop")))
    return found.groupBy(*UNIT).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def _joined(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans as maximal ones."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    opens = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[opens], reach[np.append(opens[1:], True)]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every row: the byte spans taken out and the bytes that remain."""
    if not WINDOW <= size < 1 << BITS:
        raise ValueError(f"size must be from {WINDOW} to {(1 << BITS) - 1}")
    texts = _texts(docs, id_col, text_col)
    found = stored(repeats(texts, size), "repeats").withColumnsRenamed({u: f"_{u}" for u in UNIT})
    same = texts["doc_id"].eqNullSafe(found["_doc_id"]) & (texts["digest"] == found["_digest"])
    joined = texts.join(found, same, "left").select("doc_id", "data", "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("spans")
            flat, bounds = found.flatten(), np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(found), 0).to_numpy())))
            every = [flat.field(k).to_numpy() for k in (0, 1)]
            firsts, lasts, counts, kept = [], [], [0], []
            for row, value in enumerate(batch.column("data")):
                data, at = value.as_py(), slice(bounds[row], bounds[row + 1])
                if at.start == at.stop:
                    kept.append(data)
                    counts.append(0)
                    continue
                a, b = _joined(every[0][at], every[1][at])
                ends = zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True)
                kept.append(b"".join([data[x:y] for x, y in ends]))
                firsts.append(a)
                lasts.append(b)
                counts.append(len(a))
            gone = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int32), pa.int32()) for c in (firsts, lasts)]
            spans = pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.StructArray.from_arrays(gone, ["start", "stop"]))
            sizes = pc.binary_length(batch.column("data")).cast(pa.int64())
            columns = [batch.column("doc_id"), sizes, spans, pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary")
