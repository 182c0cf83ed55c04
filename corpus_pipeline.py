"""From documents to packed sequences: quality, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventwin.session import shared_dir
from llm import mixing, packing, quality, simhash
from llm.queries import findable, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled documents, doesn't reject."""
    findable(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of operator 6: fingerprints of three-word shingles that differ in at most two bits."""
    findable(spark)
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of the documents' words that the mix of sources takes."""
    findable(spark)
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of at most 2048 ids."""
    findable(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [("quality classifier", quality_stage), ("SimHash near-dedup", dedup_stage),
                                   ("mixing sources to target weights", mixing_stage), ("best-fit packing", packing_stage)]

#: SQL has neither the tokenizer nor the hashes; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
