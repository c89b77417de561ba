"""A byte-level convolutional network in numpy that scores the quality of whole texts.

The bytes of a text are cut into overlapping chunks that together cover it. Learned filters
slide over the bytes, each chunk keeps the largest response per filter, and the mean and the
maximum of these over all chunks are combined into one probability. Weights are learned on a
bounded sample and travel to the tasks with the function; scoring is one pass, no shuffle.

Rows: a NULL or empty text is one chunk of padding and gets that chunk's score. Repeated rows
are scored alike. Labels that are NULL are skipped, repeated ones count as their majority (a
draw as 1). With no labels of one class the score is the other's. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free

#: A chunk is CHUNK blocks long and the next one begins STEP blocks later.
BLOCK, CHUNK, STEP = 64, 4, 3
WIDTH, STRIDE, FILTERS, PAD = 8, 2, 16, 256
SLAB = 4096


@dataclass(frozen=True)
class Network:
    table: np.ndarray  # (WIDTH, 257, FILTERS): what byte b at offset j adds to each filter
    bias: np.ndarray
    mean_weight: np.ndarray
    max_weight: np.ndarray
    intercept: float


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded bytes of all texts in a row, first chunk (in blocks) and chunk count of each."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    chunks = np.maximum(1, -(-(sizes - (CHUNK - STEP) * BLOCK) // (STEP * BLOCK)))
    blocks = chunks * STEP + (CHUNK - STEP) + 1  # one block of padding keeps texts apart
    starts = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    line = np.full(int(blocks.sum()) * BLOCK + WIDTH, PAD, dtype=np.int16)
    for text, start in zip(texts, starts.tolist(), strict=True):
        line[start * BLOCK : start * BLOCK + len(text)] = np.frombuffer(text, dtype=np.uint8)
    return line, starts, chunks


def _responses(line: np.ndarray, net: Network, first: int, last: int) -> np.ndarray:
    """Filter responses of blocks ``first`` to ``last`` as (blocks, positions, FILTERS)."""
    piece = line[first * BLOCK : last * BLOCK + WIDTH].astype(np.intp)
    count = (last - first) * BLOCK // STRIDE
    out = net.table[0].take(piece[: count * STRIDE : STRIDE], axis=0)
    for j in range(1, WIDTH):
        out += net.table[j].take(piece[j : j + count * STRIDE : STRIDE], axis=0)
    return out.reshape(last - first, BLOCK // STRIDE, FILTERS)


def _pooled(texts: list[bytes], net: Network, where: bool = False):
    """Per chunk: the largest response of each filter (and, if asked, the byte where it begins)."""
    line, starts, chunks = _layout(texts)
    total = len(line) // BLOCK
    best = np.empty((total, FILTERS), dtype=np.float32)
    at = np.empty((total, FILTERS), dtype=np.int64) if where else None
    for first in range(0, total, SLAB):
        last = min(total, first + SLAB)
        responses = _responses(line, net, first, last)
        if where:
            spot = responses.argmax(axis=1)
            best[first:last] = np.take_along_axis(responses, spot[:, None, :], axis=1)[:, 0]
            at[first:last] = spot * STRIDE + np.arange(first, last)[:, None] * BLOCK
        else:
            best[first:last] = responses.max(axis=1)
    owner = np.repeat(np.arange(len(texts)), chunks)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    head = starts[owner] + offset * STEP
    rows = head[:, None] + np.arange(CHUNK)
    group = best[rows]
    top = group.max(axis=1) + net.bias
    if not where:
        return top, owner, chunks, None, None
    pick = group.argmax(axis=1)
    spots = at[rows[np.arange(len(rows))[:, None], pick], np.arange(FILTERS)]
    return top, owner, chunks, spots, line


def _features(top: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    heads = np.cumsum(chunks) - chunks
    active = np.maximum(top, 0)
    return np.add.reduceat(active, heads) / chunks[:, None], np.maximum.reduceat(active, heads)


def score_texts(texts: list[bytes], net: Network) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    top, _, chunks, _, _ = _pooled(texts, net)
    mean, high = _features(top, chunks)
    z = mean @ net.mean_weight + high @ net.max_weight + net.intercept
    return 1.0 / (1.0 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 24, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the log loss. Gradients reach only the bytes that won a chunk."""
    rng = np.random.default_rng(seed)
    p = {
        "table": rng.normal(0, 0.15, (WIDTH, PAD + 1, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, dtype=np.float32),
        "mean_weight": rng.normal(0, 0.1, FILTERS).astype(np.float32),
        "max_weight": rng.normal(0, 0.1, FILTERS).astype(np.float32),
        "intercept": np.zeros(1, dtype=np.float32),
    }
    net = lambda: Network(p["table"], p["bias"], p["mean_weight"], p["max_weight"], float(p["intercept"][0]))
    if len(set(labels.tolist())) < 2:
        only = float(labels[0]) if len(labels) else 1.0
        p |= {"mean_weight": p["mean_weight"] * 0, "max_weight": p["max_weight"] * 0}
        p["intercept"][:] = 5.0 if only >= 0.5 else -5.0
        return net()
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        pace = rate * (1 - epoch / epochs) + rate * 0.05
        for cut in range(0, len(order), batch):
            chosen = order[cut : cut + batch]
            top, owner, chunks, spots, line = _pooled([texts[i] for i in chosen], net(), where=True)
            mean, high = _features(top, chunks)
            z = mean @ p["mean_weight"] + high @ p["max_weight"] + p["intercept"]
            slope = ((1 / (1 + np.exp(-z)) - labels[chosen]) / len(chosen)).astype(np.float32)
            heads = np.cumsum(chunks) - chunks
            back = (slope / chunks)[owner][:, None] * p["mean_weight"]
            back = back + np.where(top >= high[owner], slope[owner][:, None] * p["max_weight"], 0)
            back = np.where(top > 0, back, 0).astype(np.float32)
            grad = {k: np.zeros_like(v) for k, v in p.items()}
            rows, filters = np.nonzero(back)
            for j in range(WIDTH):
                np.add.at(grad["table"][j], (line[spots[rows, filters] + j], filters), back[rows, filters])
            grad["bias"] = np.add.reduceat(back, heads).sum(axis=0)
            grad["mean_weight"] = mean.T @ slope
            grad["max_weight"] = high.T @ slope
            grad["intercept"][:] = slope.sum()
            step += 1
            for k in p:
                g = grad[k] + 1e-4 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                p[k] = (p[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net()


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that labels are never learned from; a row without an id has none to learn."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, max_docs: int = 2000, max_bytes: int = 1 << 16) -> pd.DataFrame:
    """At most ``max_docs`` labelled texts of at most ``max_bytes``, picked by a hash of their id.

    Both bounds hold at every size of input, so what reaches the driver is bounded too. Three
    of four places are offered to good texts, about their share, so that 0.5 is a fair cut.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("_label = 1").orderBy(*order).limit(max_docs - max_docs // 4).unionByName(
        known.where("_label = 0").orderBy(*order).limit(max_docs // 4)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fitting = docs.select("doc_id", text.alias("_text")).where(F.octet_length("_text") <= max_bytes)
    rows = fitting.join(F.broadcast(picked), "doc_id")  # at most max_docs ids
    best = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("_text")).limit(max_docs)
    return best.toPandas().sort_values(["doc_id", "_text"], ignore_index=True)


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 2000) -> Network:
    sample = training_sample(docs, labels, max_docs)
    texts = [t.encode("utf-8", "surrogatepass") for t in sample["_text"]]
    return train(texts, sample["_label"].to_numpy(dtype=np.float32))


def with_score(docs: DataFrame, net: Network, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``: the probability that a text is of quality 1. All columns stay."""
    schema = docs.select("*", F.lit(0.0).alias(name)).schema
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, place):
                texts = [x or b"" for x in batch.column(place).cast(pa.binary()).to_pylist()]
                scores = pa.array(score_texts(texts, net), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch, place: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text, so memory does not follow the batch."""
    lengths = pa.compute.binary_length(batch.column(place)).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row."""
    net = fit(docs, labels)
    result = with_score(docs.select("doc_id", F.col("text").cast("string").alias("text")), net)
    return result.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is judged good, with all their columns."""
    name = free(docs, "_quality")[0]
    scores = with_score(docs, fit(docs, labels), name=name)
    return scores.where(F.col(name) >= 0.5).drop(name)
