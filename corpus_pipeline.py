"""A training corpus from raw documents, as five stages over Parquet.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, in the columns of
``documents``; the last one adds the copy number and the order of the mixture. ``run`` writes what
a stage returns to the shared folder and hands the reread table to the next one, so a stage never
recomputes another and a lost executor costs a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, lines, mixing, quality, simhash
from tidemark.llm.common import stored, table
from tidemark.llm.queries import TARGETS

#: Models are trained and lines drawn by hash of their shingles, so no SQL says the same.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional network accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that another line stands for."""
    result = lines.deduplicated(docs)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every SimHash component."""
    return simhash.representatives(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in global random order."""
    return mixing.replicate(docs, TARGETS)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_test_items),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
