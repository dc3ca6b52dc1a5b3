"""A corpus pipeline over ``documents``: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
below the shared work folder and reads it again as the next stage's documents. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontaminate, near, packing, suffix, toxicity
from clickloom.llm.common import documents, ship, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar scores 0.7 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least doc_id stays."""
    return near.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 that also start elsewhere are cut from their texts.

    Bytes of a character that a cut breaks go as well; n_chars is counted anew. A document
    of which nothing stays is dropped.
    """
    return suffix.without_repeats(docs, length=200)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, up to a fifth of its words edited, go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 1024 ids."""
    return packing.pack(docs)


def _shipped(stage):
    return lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir)


STAGES = [(stage.__name__, _shipped(stage)) for stage in (
    drop_toxic, drop_near_duplicates, cut_repeats, drop_contaminated, pack)]

# Learned scores, sketches and suffix order cannot be said in SQL; tests compare the stages
# with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
