"""Operator 13, phrase collocation mining by SON partitioning.

A phrase that occurs ``SUPPORT`` times in all occurs ``SUPPORT / SHARDS`` times in at least one of ``SHARDS`` shards, so
mining each shard at that lowered support misses nothing:

1. The blocks of documents (``blocks.py``) are dealt to the shards. A block counts the hashes of all its phrases of one
   to ``LONGEST`` words and sends each hash once to its bucket.
2. A bucket adds up every shard apart, at the lowered support, and unites what is frequent in any shard; what all shards
   together leave below the support (a block sends its counts up to that) is no candidate. Each block that holds a
   united hash is told so. No shard is mined by one task and no list of phrases is broadcast.
3. The blocks count their candidates again, now as words, and the sums over all blocks are the exact counts.

A hash only chooses candidates: two phrases with one hash make each other candidates at most, never share a count.
Scores are exact in 38-digit decimals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entryclime.llm.blocks import GapPacking, blocked, bucket_bits, input_bytes, mixed, ranges, runs
from entryclime.session import write_stage

SUPPORT = 10
LONGEST = 3
SHARDS = 4
TOP = 2000
UNKNOWN = "und"
#: Text bytes that one pass of array operations takes.
SEGMENT_BYTES = 1 << 20
_BREAK = re.compile(rb"[\x20\x09\x0A-\x0D.,;:!?]")
_NEXT_WORDS = re.compile(rb"(?:[\x20\x09]*[^\x20\x09\x0A-\x0D.,;:!?]+){0,%d}" % (LONGEST - 1))
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"\x20\x09")] = 1
_KIND[list(b".,;:!?\x0A\x0B\x0C\x0D")] = 2
#: Odd multipliers of the two word hashes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _segments(data: bytes) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``SEGMENT_BYTES``: the part with the words that phrases reach into, and its own length."""
    at = 0
    while at < len(data):
        cut = _BREAK.search(data, at + SEGMENT_BYTES)
        end = cut.end() if cut else len(data)
        yield data[at:_NEXT_WORDS.match(data, end).end()], end - at
        at = end


def _batches(texts: list[bytes], owners: list[int]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined by line feeds (which no phrase crosses): bytes, where each part starts, its own end, its owner."""
    held, size = [], 0
    for text, owner in zip(texts, owners, strict=True):
        for part, own in _segments(text):
            if held and size + len(part) > SEGMENT_BYTES:
                yield _joined(held)
                held, size = [], 0
            held.append((part, own, owner))
            size += len(part) + 1
    if held:
        yield _joined(held)


def _joined(held: list[tuple[bytes, int, int]]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) + 1 for p, _, _ in held])
    starts = np.cumsum(sizes) - sizes
    return (b"\n".join(p for p, _, _ in held).lower(), starts, starts + np.array([n for _, n, _ in held]),
            np.array([o for _, _, o in held]))


class _Powers:
    """Powers of a base and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = [np.full(n, b, np.uint64) for b in (self.base, self.inverse)]
            for s in steps:
                s[0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(s) for s in steps)
        return self.up[:n], self.down[:n]


_POWERS = tuple(_Powers(b) for b in _BASES)


def _word_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    up, down = _POWERS[which].upto(len(codes) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:-1])])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Phrases:
    """All phrases of one to ``LONGEST`` words of a joined batch of texts."""

    def __init__(self, data: bytes, starts: np.ndarray, own: np.ndarray, owner: np.ndarray, salt: np.ndarray):
        self.data = data
        codes = np.frombuffer(data, np.uint8)
        kind = _KIND[codes]
        edge = np.diff(np.concatenate([[0], (kind == 0).astype(np.int8), [0]]))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        piece = np.cumsum(kind == 2)[self.starts] if len(self.starts) else np.empty(0, np.int64)
        part = np.searchsorted(starts, self.starts, "right") - 1
        counted = self.starts < own[part]
        self.owner = owner[part]
        self.word_owners = self.owner[counted]
        hashes = [_word_hashes(codes, self.starts, self.ends, w) for w in (0, 1)]
        self.first, self.length, self.keys = [], [], ([], [])
        running = [h + salt[self.owner] for h in hashes]
        whole = counted
        with np.errstate(over="ignore"):
            for n in range(1, LONGEST + 1):
                if n > 1:
                    size = max(0, len(self.starts) - n + 1)
                    whole = whole[:size] & (piece[:size] == piece[n - 1:])
                    running = [mixed(r[:size] * np.uint64(b) + h[n - 1:])
                               for r, h, b in zip(running, hashes, _BASES, strict=True)]
                at = np.flatnonzero(whole)
                self.first.append(at)
                self.length.append(np.full(len(at), n))
                for kept, r in zip(self.keys, running, strict=True):
                    kept.append(mixed(r[at] + np.uint64(n)))
        self.first, self.length = np.concatenate(self.first), np.concatenate(self.length)
        self.keys = tuple(np.concatenate(k) for k in self.keys)

def _block_phrases(table: pa.Table) -> tuple[list[str], Iterator[Phrases]]:
    """The languages of a block and its phrases, a batch of texts at a time."""
    langs = table.column("lang").to_pylist()
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    salt = np.array([xxhash.xxh64_intdigest(name.encode()) for name in names], np.uint64)
    texts = table.column("text").to_pylist()
    return names, (Phrases(*batch, salt) for batch in _batches(texts, [number[x] for x in langs]))


def _mine(packing: GapPacking, most: int):
    """A block's different phrase hashes to their buckets, each with its count up to ``most``."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shorts, counts = [], []
        for phrases in _block_phrases(table)[1]:
            short = np.sort(packing.short(phrases.keys[0]))
            starts = runs(short)
            shorts.append(short[starts])
            counts.append(np.diff(np.append(starts, len(short))))
        short, count = (np.concatenate(x) if x else np.empty(0, t)
                        for x, t in ((shorts, np.uint64), (counts, np.int64)))
        order = np.argsort(short, kind="stable")
        short, starts = short[order], runs(short[order])
        total = np.add.reduceat(count[order], starts) if len(starts) else count
        bucket, payload = packing.pack(short[starts], np.minimum(total, most))
        return pa.table({"bucket": pa.array(bucket, pa.int32()), "payload": payload,
                         "block": pa.array(np.full(len(bucket), key[0].as_py()))})
    return run


def _unite(packing: GapPacking, shards: int, least: int, support: int):
    """The hashes of a bucket that are frequent in any shard, to every block that holds them."""
    def run(table: pa.Table) -> pa.Table:
        buckets, blocks = table.column("bucket").to_numpy(), table.column("block").to_numpy()
        short, count, counts = packing.unpack(buckets, table.column("payload"))
        held = np.repeat(np.arange(len(blocks)), counts)
        order = np.lexsort((blocks[held] % shards, short))
        by_shard = np.flatnonzero(np.concatenate([[True], (np.diff(short[order]) != 0)
                                                  | (np.diff((blocks[held] % shards)[order]) != 0)]))
        local = np.add.reduceat(count[order].astype(np.int64), by_shard)
        whole = runs(short[order][by_shard])
        united = short[order][by_shard[whole]][(np.maximum.reduceat(local, whole) >= least)
                                               & (np.add.reduceat(local, whole) >= support)]
        found = np.flatnonzero(_among(short, united))
        starts = runs(held[found])
        rows, payloads = held[found][starts], []
        for lo, hi in ranges(starts, len(found)):
            payloads.append(packing.pack(short[found[lo:hi]], np.zeros(hi - lo, np.uint64))[1][0].as_py())
        return pa.table({"block": pa.array(blocks[rows]), "bucket": pa.array(buckets[rows], pa.int32()),
                         "payload": pa.array(payloads, pa.binary())})
    return run


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _equal(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal pairs of hashes side by side, and where the different ones start."""
    order = np.argsort(a, kind="stable")
    starts = runs(a[order])
    if not np.array_equal(b[order], np.repeat(b[order[starts]], np.diff(np.append(starts, len(a))))):
        order = np.lexsort((b, a))
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)]))
    return order, starts


def _count(packing: GapPacking):
    """Exact counts of a block's candidate phrases, and of all its words (the empty phrase)."""
    def run(texts: pa.Table, chosen: pa.Table) -> pa.Table:
        united = np.sort(packing.unpack(chosen.column("bucket").to_numpy(), chosen.column("payload"))[0])
        names, batches = _block_phrases(texts)
        words = np.zeros(len(names), np.int64)
        data, columns = [], [[] for _ in range(7)]
        for phrases in batches:
            words += np.bincount(phrases.word_owners, minlength=len(names))
            at = np.flatnonzero(_among(packing.short(phrases.keys[0]), united))
            a, b = (k[at] for k in phrases.keys)
            order, starts = _equal(a, b)
            one = at[order[starts]]
            first, length = phrases.first[one], phrases.length[one]
            for column, values in zip(columns, (a[order[starts]], b[order[starts]], np.diff(np.append(starts, len(at))),
                                                phrases.starts[first], phrases.ends[first + length - 1], length,
                                                len(names) * len(data) + phrases.owner[first]), strict=True):
                column.append(values)
            data.append(phrases.data)
        a, b, n, begin, end, length, source = (np.concatenate(c) if c else np.empty(0, np.int64) for c in columns)
        order, starts = _equal(a, b)
        total = np.add.reduceat(n[order], starts) if len(starts) else np.empty(0, np.int64)
        one = order[starts]
        owner = [names[k] for k in (source[one] % len(names)).tolist()]
        phrase = [data[k][i:j] if m == 1 else b" ".join(data[k][i:j].split()) for k, i, j, m in
                  zip((source[one] // len(names)).tolist(), begin[one].tolist(), end[one].tolist(), length[one].tolist(),
                      strict=True)]
        return pa.table({"lang": pa.array(owner + names, pa.string()),
                         "phrase": pa.array(phrase + [b""] * len(names), pa.binary()),
                         "f": pa.array(np.concatenate([total, words]).astype(np.int64))})
    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                  shards: int = SHARDS) -> DataFrame:
    """Exact counts ``lang, words, phrase, f`` of all phrases of one to three words with at least ``support`` occurrences.

    Rows with ``words`` 0 hold a language's number of words. Words are counted within pieces, lower-cased A-Z; a null
    text is empty, a null language ``und``. Documents of any length are cut between words, with the words that a phrase
    reaches into; only a single word longer than a segment is taken whole. Repeated rows count as often as they occur,
    an empty table gives no rows; other columns are not read.
    """
    least = -(-support // shards)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    total = input_bytes(docs, text)
    packing = GapPacking(bucket_bits(total), 36, support.bit_length())
    texts = blocked(docs, [F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                           text.alias("text")], total, parts=2)
    mined = texts.groupBy("_block").applyInArrow(_mine(packing, support), "bucket int, payload binary, block long")
    chosen = mined.groupBy("bucket").applyInArrow(_unite(packing, shards, least, support),
                                                  "block long, bucket int, payload binary")
    counted = texts.groupBy("_block").cogroup(chosen.groupBy("block")).applyInArrow(
        _count(packing), "lang string, phrase binary, f long")
    phrase = F.col("phrase").cast("string")
    words = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ", -1)))
    return (counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
            .select("lang", words.alias("words"), phrase.alias("phrase"), "f")
            .where((F.col("words") == 0) | (F.col("f") >= support)))


def _exact(name: str):
    return F.col(name).cast("decimal(19,0)")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 shards: int = SHARDS, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases of two and three words: ``lang, rank, phrase, a, l, r, n, score``.

    ``score`` is floor(1000000 a a / (l r)) of a phrase's lowest-scoring cut into a first part (``l`` occurrences) and a
    rest (``r``), the first of equals. A phrase inside a longer one that makes up half of its occurrences or more is
    left out. Ranks go by score and a, descending, then the phrase in byte order, so there are no ties. Nulls, empty
    and long texts, repeats and empty tables are as in ``phrase_counts``.
    """
    counts = write_stage(phrase_counts(docs, text_col, lang_col, support, shards), "phrase_counts")
    words = F.split("phrase", " ", -1)
    spaced = F.array_join

    def parts(k):
        return F.struct(k.alias("k"), spaced(F.slice("_words", F.lit(1), k), " ").alias("left"),
                        spaced(F.slice("_words", k + 1, F.col("words") - k), " ").alias("right"))

    phrases = counts.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), words.alias("_words"))
    cuts = phrases.select("lang", "words", "phrase", "a",
                          F.inline(F.transform(F.sequence(F.lit(1), F.col("words") - 1), parts)))
    known = counts.where("words > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), "f")
    for side, name in (("left", "l"), ("right", "r")):
        part = known.withColumnRenamed("f", name)
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    scored = cuts.withColumn("score", (_exact("a") * _exact("a") * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)"))
    scored = scored.withColumn("score", F.expr("score div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    lowest = scored.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    inner = F.array(*[F.struct(spaced(F.slice("_words", F.lit(s), F.lit(m)), " ").alias("part"))
                      for m in range(2, LONGEST) for s in range(1, LONGEST - m + 2)])
    longer = (phrases.where(F.col("words") == LONGEST).select("lang", "a", F.inline(inner))
              .groupBy(F.col("lang").alias("_lang"), F.col("part").alias("_part")).agg(F.max("a").alias("_most")))
    kept = (lowest.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left")
            .where(F.col("_most").isNull() | (100 * F.col("_most") < 50 * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select(F.col("lang").alias("_of"), F.col("f").alias("n"))
    return ranked.join(sizes, F.col("lang") == F.col("_of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("_cut.l").alias("l"),
        F.col("_cut.r").alias("r"), "n", F.col("_cut.score").cast("long").alias("score"))
