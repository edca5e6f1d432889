"""The corpus pipeline: quality, exact copies, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a DataFrame; `run` lands each
result as Parquet and reads it again for the next one. All stages but the last return the columns of `documents`; the last
one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetweave.llm import exactdup, minhash, packing, quality, secretscan
from assetweave.llm.queries import SEQUENCE, TOKENIZER
from assetweave.llm.scratch import land


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the clean grade is high enough; fitted on the labels of these documents."""
    return quality.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exactdup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 or more."""
    return minhash.drop_near_copies(docs, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked in their texts."""
    return secretscan.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents' tokens, packed into sequences."""
    return packing.pack_documents(docs, TOKENIZER, end=0, capacity=SEQUENCE)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

# A fitted model, a similarity search and a packing search are not expressible in SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), "pipeline")
    return docs
