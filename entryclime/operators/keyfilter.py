"""A membership filter over hashed keys, for a broadcast whose size is chosen from the number of keys.

The filter is a table of 64-bit words. A key sets four bits of one word, so a test is one lookup of an integer. With
16 bits a key it takes about one foreign key in forty for a member, and never misses one. It is never larger than
``MOST_WORDS``; with more keys it takes more foreign keys for members, up to all of them. What uses it must be right
then too, since a filter only says which rows need no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 1 << 10
#: 2^20 words of 16 bytes: a broadcast of 16 MB at most, for four million keys at full strength.
MOST_WORDS = 1 << 20
KEYS_PER_WORD = 4


def words_for(keys: int) -> int:
    """The number of words for so many keys: a power of two within the bounds."""
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << max(0, -(-keys // KEYS_PER_WORD) - 1).bit_length()))


def _word(key: Column, words: int) -> Column:
    return F.pmod(key, F.lit(words))


def _bits(key: Column) -> Column:
    picked = [F.call_function("shiftleft", F.lit(1).cast("long"),
                              F.shiftrightunsigned(key, at).bitwiseAND(F.lit(63)).cast("int")) for at in (40, 46, 52, 58)]
    out = picked[0]
    for p in picked[1:]:
        out = out.bitwiseOR(p)
    return out


def filter_words(keys: DataFrame, key: str, words: int) -> DataFrame:
    """The filter over the longs in ``key``: at most ``words`` rows (``_word``, ``_bits``), folded before the exchange."""
    return keys.groupBy(_word(F.col(key), words).alias("_word")).agg(F.bit_or(_bits(F.col(key))).alias("_bits"))


def mark_members(df: DataFrame, filled: DataFrame, key: str, words: int, flag: str) -> DataFrame:
    """Add ``flag``: whether the long ``key`` may be among the filter's keys."""
    own = filled.select(F.col("_word").alias(f"{flag}_word"), F.col("_bits").alias(f"{flag}_bits"))
    joined = df.join(F.broadcast(own), _word(df[key], words) == own[f"{flag}_word"], "left")
    mask = _bits(df[key])
    hit = F.coalesce(own[f"{flag}_bits"].bitwiseAND(mask) == mask, F.lit(False))
    return joined.select(*[df[c] for c in df.columns], hit.alias(flag))
