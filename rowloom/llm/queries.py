"""Registered queries of the operators in this folder, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom.llm import (decontaminate, divergence, language, licenses, near_copies, neighbours, packing, resampling,
                         shards, sql, suffix_tree, token_counts, token_files, toxicity)
from rowloom.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    embeddings = table(spark, folder, "embeddings")
    index, n = neighbours.build_index(embeddings)
    return neighbours.nearest(index, n, embeddings.filter(F.col("vec_id") % 20 == 0), k=20)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learned from the documents that aren't held out."""
    return language.identify(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 2048 ids."""
    return packing.pack(table(spark, folder, "documents"), TOKENIZER, end_id=1, then=packing.digested,
                        columns=packing.DIGESTS)


def op4_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Unigram and suffix-tree scores of every text."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    return suffix_tree.score(table(spark, folder, "documents"), held_out)


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document inside windows of benchmark items."""
    return decontaminate.report(decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of the categories for every document, learned from the labelled ones."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels"))).withColumnRenamed("rejected", "toxic")


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards, equal texts together."""
    return shards.place(table(spark, folder, "documents"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as ids in files, read back."""
    return token_files.read_token_files(
        *token_files.write_token_files(table(spark, folder, "documents"), TOKENIZER, end_id=2))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    return licenses.scan(table(spark, folder, "documents"))


def op10_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 85 of 100 four-word shingles."""
    return near_copies.group_copies(table(spark, folder, "documents"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text, and whether they are more than 4096."""
    return token_counts.count_tokens(table(spark, folder, "documents"), PIECES, limit=4096)


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the documents drawn towards the words of the benchmark; every document's score."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How the sources of each language differ from each other and from the language."""
    return divergence.audit(table(spark, folder, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def all_sql() -> dict[str, str]:
    return dict(sql.ALL)
