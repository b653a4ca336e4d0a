"""From raw documents to token files: quality, near-duplicates, benchmark passages, mix, output.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it to the shared folder and reads it
again as the next stage's documents. All stages but the last return the columns of documents. Defined
results for NULLs, empty texts, repeated rows and empty tables are those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskfeat.llm.decontaminate import decontaminated
from riskfeat.llm.minhash_dedup import without_near_duplicates
from riskfeat.llm.mixing import mix
from riskfeat.llm.quality_rules import keep_good
from riskfeat.llm.text import shared_path, written
from riskfeat.llm.token_files import token_file_digest, write_token_files

TOKENIZER = "word_bpe_49k.json"
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return without_near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, as it is or with other numbers, names and units."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target shares of their sources, repeated where a source's budget asks for it."""
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files of all documents; per document its place, size and checksum as the files have them."""
    path = shared_path(spark, "token-files")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return token_file_digest(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# near-duplicates and tokens are beyond SQL; tests hold run() against a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
