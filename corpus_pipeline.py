"""A training corpus from raw documents: toxic texts, repeated passages, near duplicates and benchmark texts go, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.common import documents, staged
from emberlog.llm.decontaminate import drop_contaminated
from emberlog.llm.jaccard import keep_one
from emberlog.llm.lines import PASSAGE, dedup_lines
from emberlog.llm.packing import pack_documents
from emberlog.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; empty and null texts match nothing and stay."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go out of the texts; a document goes if it had words and all of them were repeated."""
    done = dedup_lines(docs.withColumn("n_chars", F.length("text").cast("long")), passage=PASSAGE)
    words = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     ")) != ""
    changed = F.col("n_removed_lines") > 0
    kept = done.where(~changed | words).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays; empty ones all stay."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more inside benchmark windows go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, null and empty texts too, as pieces of sequences of at most 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Learned scores and token ids are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
