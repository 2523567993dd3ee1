"""From raw documents to packed training sequences: the operators of ``minutelake.llm`` one after the other.

Each stage takes (spark, docs, sf_dir), works on every row that the one before left, and returns a DataFrame with the
columns of ``documents``; the last returns the packed pieces. Rows keep their ``doc_id`` throughout; after the mix, a
document that is taken more than once comes as several rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from minutelake.llm import language_id, mixing, ngram_jaccard, packing, quality_rules
from minutelake.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.keep_identified(spark, docs, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a similarity of 0.8 of five-word shingles."""
    return ngram_jaccard.one_of_each_group(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of the sources, mixed to their target weights."""
    return mixing.mixed_documents(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of token ids lies in which sequence."""
    return packing.pack(spark, packing.pieces_of(docs, packing.tokenizer_path()))


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: neither the learned rules nor the drawn blocks can be said in SQL; tests hold the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(spark, docs, f"stage_{number}")
    return docs
