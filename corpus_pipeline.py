"""A training corpus from documents: quality rules, near-duplicates, repeated passages, mix, tokens.

Each stage works on all rows that the one before kept, written as Parquet and read again. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parchment.llm.bpe import encode_documents
from parchment.llm.common import stage_table, table
from parchment.llm.mixing import mixed_documents
from parchment.llm.neardup import first_of_classes
from parchment.llm.quality import kept_documents
from parchment.llm.suffixes import dedup_texts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return first_of_classes(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of suffixes.PASSAGE bytes that start at two places go, everywhere; their documents stay.

    A null text becomes empty, and a text that is cut to nothing stays as an empty document.
    """
    return dedup_texts(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each pass over a document, full or partial."""
    return mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the mix."""
    return encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: SQL has no Order MinHash with alignment and no BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
