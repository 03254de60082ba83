"""Queries of the operators, as the driver registers them, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waybill.llm import (
    language,
    lexical_search,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    packing,
    quality,
    simhash,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from waybill.llm.shared import new_folder, table
from waybill.llm.tokens import CACHED_WORDS_ALONE

Query = Callable[[SparkSession, str], DataFrame]

#: The end ids of the two vocabularies.
BYTE_END, WORD_END = 2, 0


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary, BYTE_END)
    return token_files.read_token_files(spark, folder)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(
        docs, vocabulary, WORD_END, cached_words=CACHED_WORDS_ALONE
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_neighbours": op7_neighbours,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_language": op10_language,
    "op11_token_counts": op11_token_counts,
    "op12_whitening": op12_whitening,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op2_mixing": mixing.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op9_licenses": licenses.sql(),
    "op13_lexical_search": lexical_search.SQL,
}
