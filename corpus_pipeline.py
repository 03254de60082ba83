"""From raw documents to packed sequences, in five stages.

Each stage takes what its predecessor kept and returns the columns of
``documents``; the last one returns packed pieces with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waybill.llm import line_dedup, mixing, packing, quality, simhash
from waybill.llm.shared import staged, table

#: Fixed value: the end id of the vocabulary.
END_ID = 0


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like the trusted ones."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; each such line stays in one."""
    return line_dedup.without_shared_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link."""
    return simhash.without_near_duplicates(docs, shingle_words=3, link_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their place in a sequence."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, vocabulary, END_ID, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Fingerprints, tokens and hashed n-grams have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
