"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the mixture. Its mean repetition rate is that share of the
whole size over the source's own size, and each document is repeated as often as a Poisson
variable of that mean says: the variable's distribution is inverted at a number hashed from the
seed and the document's identity, so a rerun, a retry or another partitioning gives the same
copies. A large mean is drawn as a sum of independent Poisson variables of mean ``PIECE`` at most.
Copies are dealt to partitions by a hash and sorted by it inside, which is a global shuffle.

Rows: a NULL source is a source of its own. A NULL text has size 0; a source of size 0 keeps a
rate of 1. A NULL doc_id is replaced by a digest of the text. Repeated rows are repeated alike.
An empty table gives an empty result. Extra columns are carried along; ``copy`` and
``order_key`` of ``docs`` give way to those of the result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free, small_enough

PIECE, SALTS = 32, 64
MAX_BROADCAST_SOURCES = 20_000


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def identity() -> Column:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text)))


def _distribution(mean: Column) -> Column:
    """Cumulated probabilities of 0, 1, ... until nothing is left in double precision."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    none = F.struct(
        F.lit(0.0).alias("p"), F.lit(0.0).alias("c"), F.array().cast("array<double>").alias("all")
    )

    def grow(acc: Column, k: Column) -> Column:
        p = F.when(k == 0, F.exp(-mean)).otherwise(acc["p"] * mean / k)
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(0), last), none, grow, lambda acc: acc["all"])


def rates(docs: DataFrame, targets: Mapping[str, float], other: float = 1.0) -> DataFrame:
    """``(source, rate)``: the mean number of copies of each source's documents.

    ``targets`` are relative weights; a source that is not named has weight ``other``.
    """
    size = F.sum(F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0))).alias("size")
    sizes = docs.groupBy("source").agg(size)
    weight = F.lit(float(other))
    for name, value in targets.items():
        weight = F.when(F.col("source") == name, float(value)).otherwise(weight)
    weighted = sizes.withColumn("weight", weight)
    whole = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.col("weight") * F.col("all_size") / (F.col("all_weight") * F.col("size"))
    # one row, known by construction: broadcasting it is bounded
    return weighted.crossJoin(F.broadcast(whole)).select(
        "source", F.when((F.col("size") > 0) & (F.col("all_weight") > 0), rate).otherwise(F.lit(1.0)).alias("rate")
    )


def replicate(docs: DataFrame, targets: Mapping[str, float], other: float = 1.0, seed: int = 42) -> DataFrame:
    """``docs`` repeated to the target weights, with ``copy`` (from 1) and ``order_key``, shuffled."""
    docs = docs.drop("copy", "order_key")
    its_source, pieces, below, own, its_salt, copies = free(docs, "_source", "_pieces", "_below", "_salt", "_plan_salt", "_copies")
    plan = rates(docs, targets, other).withColumn(pieces, F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int"))
    plan = plan.select(F.col("source").alias(its_source), pieces, _distribution(F.col("rate") / F.col(pieces)).alias(below))
    same = F.col("source").eqNullSafe(F.col(its_source))
    if small_enough(plan.select(its_source), MAX_BROADCAST_SOURCES):
        planned = docs.join(F.broadcast(plan), same)
    else:  # many sources: a hot one is spread over salts
        salt = F.pmod(F.xxhash64(identity()), F.lit(SALTS))
        spread = plan.withColumn(its_salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        planned = docs.withColumn(own, salt).join(spread, same & (F.col(own) == F.col(its_salt))).drop(own, its_salt)

    def drawn(total: Column, piece: Column) -> Column:
        at = _uniform(F.lit(str(seed)), identity(), piece.cast("string"))
        return total + F.size(F.filter(below, lambda c: c <= at))

    count = F.aggregate(F.sequence(F.lit(1), F.col(pieces)), F.lit(0), drawn)
    counted = planned.withColumn(copies, count).drop(its_source, pieces, below)
    exploded = counted.where(F.col(copies) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(copies))))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), identity(), F.col("copy").cast("string")))
    keyed = exploded.drop(copies).withColumn("order_key", key)
    return keyed.repartition("order_key").sortWithinPartitions("order_key")


def replicate_sql(targets: Mapping[str, float], other: float = 1.0, seed: int = 42) -> str:
    """The same copies in DuckDB SQL over ``documents``."""
    cases = " ".join(f"WHEN source = '{name}' THEN {float(value)}" for name, value in targets.items())
    return f"""
WITH RECURSIVE docs AS (
  SELECT *, coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, ''))) AS ident FROM documents
), sizes AS (
  SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size,
         (CASE {cases} ELSE {float(other)} END)::DOUBLE AS weight
  FROM documents GROUP BY source
), rated AS (
  SELECT source, CASE WHEN size > 0 AND sum(weight) OVER () > 0
      THEN weight * (sum(size) OVER ()) / ((sum(weight) OVER ()) * size) ELSE 1.0 END AS rate FROM sizes
), pieces AS (
  SELECT source, rate, greatest(ceil(rate / {PIECE}), 1)::INT AS pieces FROM rated
), grown AS (
  SELECT source, 0 AS k, exp(-rate / pieces) AS p, exp(-rate / pieces) AS c FROM pieces
  UNION ALL
  SELECT g.source, g.k + 1, g.p * (r.rate / r.pieces) / (g.k + 1), g.c + g.p * (r.rate / r.pieces) / (g.k + 1)
  FROM grown g JOIN pieces r ON g.source IS NOT DISTINCT FROM r.source
  WHERE g.k + 1 <= ceil(r.rate / r.pieces + 12 * sqrt(r.rate / r.pieces) + 24)
), tables AS (
  SELECT source, list(c ORDER BY k) AS below FROM grown GROUP BY source
), draws AS (
  SELECT d.*, t.below, unnest(range(1, r.pieces + 1)) AS piece
  FROM docs d JOIN pieces r ON d.source IS NOT DISTINCT FROM r.source
  JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
), spots AS (
  SELECT * EXCLUDE (below, piece), len(list_filter(below, lambda x : x <=
    (('0x' || substr(md5('{seed}:' || ident || ':' || piece), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)) AS n
  FROM draws
), counted AS (
  SELECT doc_id, text, lang, source, n_chars, ident, sum(n)::INT AS copies
  FROM spots GROUP BY ALL
), copied AS (
  SELECT * EXCLUDE (copies), unnest(range(1, copies + 1))::INT AS copy FROM counted
)
SELECT doc_id, text, lang, source, n_chars, copy, md5('{seed}:order:' || ident || ':' || copy) AS order_key FROM copied
"""
