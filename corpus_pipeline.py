"""Corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Each stage works on all rows that the one before kept, read again from the shared
folder; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubeguard.llm.common import store
from cubeguard.llm.exact_dedup import keep_first
from cubeguard.llm.language_id import keep_identified
from cubeguard.llm.minhash_dedup import near_duplicates
from cubeguard.llm.mixing import keep_mixed
from cubeguard.llm.packing import pack


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 on five-word shingles."""
    gone = near_duplicates(docs, size=5, percent=80).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled with the raked probabilities."""
    return keep_mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences."""
    return pack(docs)


STAGES = [("language ID", language), ("exact dedup", exact), ("MinHash near-dedup", near), ("mixing", mix), ("packing", packed)]

#: A recurrent network and tokenizers are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
