"""The registered queries of the corpus operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from emberlog.llm.common import documents, stage_path
from emberlog.llm.conversations import repair
from emberlog.llm.decontaminate import benchmark_hits
from emberlog.llm.html import main_text
from emberlog.llm.jaccard import near_duplicates
from emberlog.llm.lines import DEDUP_SQL, dedup_lines
from emberlog.llm.packing import pack_documents
from emberlog.llm.pii import find_pii
from emberlog.llm.quality import quality
from emberlog.llm.secrets import find_secrets
from emberlog.llm.token_counts import token_counts
from emberlog.llm.token_files import read_token_files, write_token_files
from emberlog.llm.toxicity import toxicity
from emberlog.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed_lines")


ORACLES["op6_line_dedup"] = DEDUP_SQL


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


@query
def op4_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op5_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("text_key")


@query
def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir)).drop("text_key")


@query
def op8_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op10_count_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("set")


@query
def op11_persistent_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = stage_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    return read_token_files(spark, folder)
