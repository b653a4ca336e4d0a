"""The queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskfeat.llm.chat_perspectives import ORACLE_PERSPECTIVES, perspective_table
from riskfeat.llm.collocations import ORACLE_COLLOCATIONS, collocations
from riskfeat.llm.decontaminate import contaminations
from riskfeat.llm.exact_topk import ORACLE_TOP, nearest
from riskfeat.llm.hmm_lm import language_scores
from riskfeat.llm.line_dedup import duplicate_lines
from riskfeat.llm.minhash_dedup import near_duplicates, oracle_near_duplicates
from riskfeat.llm.mixing import ORACLE_AMOUNTS, mix_amounts
from riskfeat.llm.pii_spans import pii_digest
from riskfeat.llm.quality_rules import ORACLE_QUALITY, quality_report
from riskfeat.llm.text import shared_path
from riskfeat.llm.token_counts import token_counts
from riskfeat.llm.token_files import token_file_digest, write_token_files
from riskfeat.llm.whitening import whitened_vectors
from riskfeat.plans.tables import table

WORD_BPE = "word_bpe_49k.json"
NEAR_WORDS, NEAR_PERCENT = 3, 85


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(spark, folder, "documents"))


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_lines(table(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"), each_window=True)


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_amounts(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


def op6_hmm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return language_scores(table(spark, folder, "documents"))


def op7_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii_digest(table(spark, folder, "documents"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_file_digest(spark, path)


def op9_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return perspective_table(table(spark, folder, "conversations"))


def op10_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), NEAR_WORDS, NEAR_PERCENT)


def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_vectors(table(spark, folder, "embeddings"))


def op12_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


REGISTRY = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_mix_sources": op4_mix_sources,
    "op5_token_counts": op5_token_counts,
    "op6_hmm_scores": op6_hmm_scores,
    "op7_pii_spans": op7_pii_spans,
    "op8_token_files": op8_token_files,
    "op9_chat_perspectives": op9_chat_perspectives,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_phrase_collocations": op13_phrase_collocations,
}

# the others are beyond SQL: tests hold them against brute force
ORACLE: dict[str, str] = {
    "op1_quality_rules": ORACLE_QUALITY,
    "op4_mix_sources": ORACLE_AMOUNTS,
    "op9_chat_perspectives": ORACLE_PERSPECTIVES,
    "op10_minhash_dedup": oracle_near_duplicates(NEAR_WORDS, NEAR_PERCENT),
    "op12_exact_top_k": ORACLE_TOP,
    "op13_phrase_collocations": ORACLE_COLLOCATIONS,
}
