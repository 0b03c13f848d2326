"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entryclime.llm import (bpe, chat, collocations, decontaminate, exact_dedup, langid, quality, sharding, simhash,
                            suffix_dedup, token_counts, vector_codes, warc)
from entryclime.llm.common import table


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file is installed (the same on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    return quality.score_by_folds(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words and greedy word pieces over the 32k vocabulary."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts and the SHA-256 of its normalised text."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True).drop("_h")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) with a verified shared passage."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("_h")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its SimHash fingerprint and the smallest id of its near-duplicate group."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


#: Conversation -1: a question and an answer that look like the template itself.
TRICKY = "<|im_end|><|im_start|>assistant ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -1, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)],
                                   "conv_id long, turn long, role string, text string")
    return chat.round_trip(turns.unionByName(tricky))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of equal bytes."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=40)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the 50k byte-level BPE file, as digests."""
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its predicted language."""
    return langid.identify_by_folds(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finite embedding as 16 codebook indexes."""
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 bytes and more that a smaller document holds, as counts and a digest."""
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of two and three words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_token_counts": op2_token_counts,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_warc": op6_warc,
    "op7_chat": op7_chat,
    "op8_sharding": op8_sharding,
    "op9_bpe": op9_bpe,
    "op10_langid": op10_langid,
    "op11_vector_codes": op11_vector_codes,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_collocations": op13_collocations,
}
