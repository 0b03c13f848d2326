"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entryclime.operators.keyfilter import filter_words, mark_members, words_for
from entryclime.session import write_stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fewest words of 64 flag bits in a membership filter: 2^17 rows of 16 bytes, 2 MB to broadcast.
LEAST_FILTER_WORDS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus`` (the fold of a row)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart where ids may be null or repeat: the id and a hash of the whole text.

    Rows that agree in both are copies of each other, for which every verdict is the same.
    """
    return [F.col(id_col).alias("_id"), _text_hash(F.col(text_col)).alias("_h")]


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


class Membership:
    """A filter over the different longs in ``hashed`` of a written table, of 2 MB to 16 MB by their number.

    Beyond some 16 million keys it takes more and more foreign keys for members, up to all of them, and never misses a
    key. What uses it takes the same way at every number of keys and is exact without it.
    """

    def __init__(self, keys: DataFrame, hashed: str, name: str):
        self.words = max(LEAST_FILTER_WORDS, words_for(keys.count()))
        self.filled = write_stage(filter_words(keys, hashed, self.words), name)

    def mark(self, df: DataFrame, hashed: str, flag: str) -> DataFrame:
        """Add ``flag``: whether the long ``hashed`` may be among the filter's keys (never false for a key)."""
        return mark_members(df, self.filled, hashed, self.words, flag)


def drop_rows(docs: DataFrame, out: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows keyed in ``out`` (``_id``, ``_h``); null ids compare as equal; columns unchanged.

    The keys become a filter of bounded size first, so only rows that may be meant are exchanged with them and all
    others stay in the task that scans them. The plan is the same at any number of keys.
    """
    marked = write_stage(out.select(F.col("_id").alias("_out_id"), F.col("_h").alias("_out_h")).distinct(), "rows_out")
    if marked.isEmpty():
        return docs

    def without(rows: DataFrame) -> DataFrame:
        hit = rows[id_col].eqNullSafe(marked["_out_id"]) & (_text_hash(rows[text_col]) == marked["_out_h"])
        return rows.join(marked, hit, "left_anti")

    keys = marked.select(F.xxhash64("_out_id", "_out_h").alias("_key"))
    members = Membership(keys, "_key", "rows_out_filter")
    key, flag = _unused(docs, "_key"), _unused(docs, "_maybe")
    keyed = docs.withColumn(key, F.xxhash64(docs[id_col], _text_hash(docs[text_col])))
    split = members.mark(keyed, key, flag).drop(key)
    return split.where(~F.col(flag)).drop(flag).unionByName(without(split.where(F.col(flag)).drop(flag)))


def one_row_each(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of the rows keyed in ``keys``, the least whole row of each key; columns unchanged."""
    marked = keys.select(F.col("_id").alias("_in_id"), F.col("_h").alias("_in_h")).distinct()
    hit = docs[id_col].eqNullSafe(marked["_in_id"]) & (_text_hash(docs[text_col]) == marked["_in_h"])
    return (docs.join(marked, hit, "left_semi").groupBy(F.xxhash64(docs[id_col], _text_hash(docs[text_col])),
                                                        docs[id_col].alias("_in_id"))
            .agg(F.min(F.struct(*[docs[c] for c in docs.columns])).alias("_row")).select("_row.*"))


def keep_chosen(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``rows`` (``_id``, ``_h``, ``_stays``) does not choose; columns unchanged.

    ``rows`` has a row for each document of a group, in which one is chosen. Rows that agree in id and text share a key;
    if the chosen row is one of several, one of them stays.
    """
    verdict = write_stage(rows.groupBy("_id", "_h").agg(F.count(F.lit(1)).alias("_n"), F.max("_stays").alias("_stays"))
                          .where("_n > 1 OR NOT _stays"), "rows_verdict")
    kept = drop_rows(docs, verdict, id_col, text_col)
    repeats = verdict.where("_n > 1 AND _stays")
    return kept if repeats.isEmpty() else kept.unionByName(one_row_each(docs, repeats, id_col, text_col))


def over_batches(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A ``mapInArrow`` function that turns each batch into at most one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out
    return run
