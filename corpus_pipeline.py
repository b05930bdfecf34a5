"""Documents to packed training sequences, as a chain of named stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from occurra.llm import jaccard, packing, quality, toxicity
from occurra.llm.common import shared_dir
from occurra.llm.queries import GOOD, TOXIC


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar doesn't reject; null and empty texts have no match and stay."""
    return toxicity.without_toxic(docs, _labels(spark, sf_dir), TOXIC)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model finds good."""
    return quality.only_good(docs, _labels(spark, sf_dir), GOOD)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest id (null last).

    Components connect rows, whatever their ids; rows without words stay.
    """
    return jaccard.one_of_each(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document that is left, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("packing", pack_stage),
]

#: No SQL: tokens, the learned models and the packing aren't expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are kept in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
    return docs
