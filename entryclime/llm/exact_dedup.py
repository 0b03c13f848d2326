"""Operator 3, exact dedup by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after lower-casing A-Z; a null text counts as empty.

1. One scan counts rows by length and prefix hash. Neither needs the whole text: the length is stored with
   the value and the prefix is ``PREFIX_CHARS`` characters. A text alone in its length or prefix group is unique.
2. The groups of two or more become a membership filter of bounded size (2 to 16 MB, broadcast), never a list of
   rows, so the second scan knows its candidates without shuffling any text.
3. The second scan hashes the full content of the candidates only. Rows then travel as (id, length, SHA-256).

Counting is partial before every exchange, and the last join is between two freshly exchanged, narrow tables, so
a group that holds a third of all rows is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import Membership, ascii_lower, keep_chosen, text_or_empty
from entryclime.session import write_stage

PREFIX_CHARS = 256


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_all: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256`` and the text hash ``_h``.

    Of equal texts the row with the largest id stays (a null id is smallest). Of repeated rows (same id and text)
    exactly one is marked kept. Null and empty texts form one group. Texts of any length are hashed whole. An empty table gives no rows. Other columns,
    whatever their names, are not read. ``text_sha256`` is null for texts proven unique without reading them whole,
    unless ``digest_all`` asks for every digest; ``_h`` is null for them too.
    """
    signed = docs.select(
        F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"),
        F.octet_length(text_or_empty(text_col)).cast("long").alias("_len"),
        F.xxhash64(ascii_lower(F.substring(text_or_empty(text_col), 1, PREFIX_CHARS))).alias("_prefix"))
    signed = signed.withColumn("_group", F.xxhash64("_len", "_prefix"))
    shared = (signed.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .select(F.xxhash64("_len", "_prefix").alias("_group")))
    members = Membership(write_stage(shared, "dedup_shared"), "_group", "dedup_filter")
    digest = F.unhex(F.sha2(ascii_lower(F.col("_text")), 256))
    hashed = (members.mark(signed, "_group", "_candidate")
              .select("_id", "_len", "_candidate", F.when(F.col("_candidate"), F.xxhash64("_text")).alias("_h"),
                      (digest if digest_all else F.when(F.col("_candidate"), digest)).alias("_sha"),
                      F.monotonically_increasing_id().alias("_row")))
    hashed = write_stage(hashed, "dedup_digests")
    groups = (hashed.where("_candidate").groupBy("_len", "_sha")
              .agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("_id", "_row")).alias("_keep"))
              .where("_n > 1")
              .select(F.col("_len").alias("_glen"), F.col("_sha").alias("_gsha"), "_n", "_keep"))
    groups = write_stage(groups, "dedup_groups")
    same = (hashed["_len"] == groups["_glen"]) & (hashed["_sha"] == groups["_gsha"])
    return hashed.join(groups, same, "left").select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_n").isNull() | (F.col("_keep._row") == F.col("_row"))).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"), "_h")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, chosen as in ``exact_duplicates``; columns unchanged."""
    groups = exact_duplicates(docs, id_col, text_col).where("group_size > 1")
    return keep_chosen(docs, groups.select(F.col("doc_id").alias("_id"), "_h", F.col("kept").alias("_stays")),
                       id_col, text_col)
