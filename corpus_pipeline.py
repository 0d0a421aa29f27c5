"""From raw documents to packed sequences, stage by stage.

Every stage takes all rows of the one before, whatever their columns are called, and an
empty table gives an empty one. Repeated rows are rows of their own until the near copies go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartledger.llm import mixing, packing, quality, simhash, toxicity
from cartledger.llm.common import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null text is scored as an empty one, and rows with a null key like any other.
    """
    return quality.good_rows(docs, table(spark, sf_dir, "labels"))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic passages that decide.

    Null and empty texts have no passage and stay, rows with a null key as their texts say.
    """
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest key.

    Null and wordless texts are one group, as they share a fingerprint; of repeated rows one
    stays.
    """
    return simhash.keep_one(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, twice at most.

    A null source is a source of its own; documents without words cost nothing.
    """
    return mixing.mixed_rows(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a sequence.

    Null and empty texts are a piece of the closing id alone; repeated rows are packed each.
    """
    return packing.packed_documents(docs)


STAGES = [
    ("quality", good_documents),
    ("toxicity", clean_documents),
    ("simhash_dedup", distinct_documents),
    ("mixing", mixed_documents),
    ("packing", packed_sequences),
]

# The classifiers are trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
