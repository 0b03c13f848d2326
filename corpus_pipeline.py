"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, BPE tokens.

Each stage takes all its predecessor kept and returns a DataFrame, which is written as Parquet and read again as the
next one's documents. All but the last return the columns of ``documents``; the last returns token counts and digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from entryclime.llm import bpe, decontaminate, exact_dedup, langid, simhash
from entryclime.llm.common import table
from entryclime.llm.queries import tokenizer_path
from entryclime.session import write_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: those without a letter or far from every centroid go."""
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left as token counts and digests of their ids and decoded texts."""
    return bpe.digests(bpe.encode_decode(docs, tokenizer_path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("bpe_tokens", count_tokens),
]

#: SQL cannot express the language model, SimHash or BPE stages; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
