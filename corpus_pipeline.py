"""The training-data pipeline: quality, near-duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custodia.llm import blob_ledger, drr_packing, flow_mixing, ordinal_quality, probminhash_dedup
from custodia.llm.common import staged, table
from custodia.llm.registry import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the graded classifier accepts."""
    return ordinal_quality.selected(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return probminhash_dedup.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the scan finds taken out of their texts."""
    return blob_ledger.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return flow_mixing.repeated(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens."""
    return drr_packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", packing),
]

#: A trained classifier, sketches and a tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
