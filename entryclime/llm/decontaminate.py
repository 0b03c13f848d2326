"""Operator 4, benchmark decontamination by spaced-seed hashing, with DataFrame operations only.

A mask names the positions of a token window that are hashed; the others are ignored, so a substituted word there does
not hide the match. Hashes of all benchmark windows are joined with those of all document windows, and each hit is
verified on its alignment: ``WINDOW`` consecutive aligned tokens around the hit, of which at least ``SHARE`` are equal.
The two masks together hit every such window that differs in at most two tokens, wherever they are (a test lists all).
Items of 8 to 12 tokens get two more masks of weight 5, which together with the first hit every item with the
substitutions that ``SHARE`` allows; shorter ones are hashed as a whole. Documents meet only masks of lengths that occur.

A document is cut into blocks of ``BLOCK_TOKENS`` windows before any window becomes a row, so what a window carries does
not grow with its document. Document windows are never shuffled. A membership filter over the benchmark hashes (2 to
16 MB, broadcast) passes only windows that may be hits, and those alone, with their few neighbouring tokens, meet the
seeds. Spark's statistics decide whether the seeds are broadcast.

``contaminated`` names every (document, item) pair, which grows with both where many items share a passage.
``leaking`` only names the documents and is linear in both: the windows around hits are verified against the different
*forms* of all benchmark windows, a form being a window without as many tokens as a match may differ in. A passage
that thousands of items share has its forms once, and a window that thousands of documents share is verified once.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import Membership, drop_rows, row_key, text_or_empty
from entryclime.session import write_stage

MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
SHORT_MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5))
WINDOW = 13
#: Items of fewer tokens are found only whole.
LEAST_TOKENS = 8
SHARE = 0.8
#: Every mask with the fewest and the most tokens of the items that it serves.
_SEEDS = (*((m, LEAST_TOKENS, None) for m in MASKS), *((m, LEAST_TOKENS, WINDOW - 1) for m in SHORT_MASKS),
          *((tuple(range(n)), n, n) for n in range(1, LEAST_TOKENS)))
_REACH = max(m[-1] for m in MASKS) + WINDOW - 1
#: Windows of a document that travel together, with the tokens that they reach.
BLOCK_TOKENS = 256


def _serves(which: int, tokens: int) -> bool:
    _, least, most = _SEEDS[which]
    return least <= tokens and (most is None or tokens <= most)


def _tokens(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits; the first and last may be empty, which equals no benchmark token."""
    return F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+")


def _mask_hash(tokens: str, at: str, which: int) -> Column:
    """Hash of the masked tokens at ``at``; null where the window runs past the end."""
    mask = _SEEDS[which][0]
    picked = [F.get(F.col(tokens), F.col(at) + o) for o in mask]
    return F.when(F.col(at) + mask[-1] < F.size(tokens), F.xxhash64(F.lit(which), *picked))


def _around(tokens: str, at: str) -> Column:
    """The aligned tokens that any verified window over a hit can touch; null outside the text."""
    return F.transform(F.sequence(F.lit(1 - WINDOW), F.lit(_REACH)), lambda d: F.get(F.col(tokens), F.col(at) + d))


def _windows(docs: DataFrame) -> DataFrame:
    """Every position of every document: ``_id, _h``, the block's ``_tokens``, ``_at`` in them and ``_pos`` in the text."""
    before, after = WINDOW - 1, _REACH

    def block(start: Column) -> Column:
        lead = F.least(start, F.lit(before))
        return F.struct(start.alias("start"), lead.alias("lead"),
                        F.slice(F.col("_all"), start - lead + 1, lead + BLOCK_TOKENS + after).alias("tokens"))

    starts = F.sequence(F.lit(0), F.greatest(F.size("_all") - 1, F.lit(0)), F.lit(BLOCK_TOKENS))
    blocks = docs.select("_id", "_h", F.explode(F.transform(starts, block)).alias("_block"))
    at = blocks.select("_id", "_h", F.col("_block.start").alias("_start"), F.col("_block.lead").alias("_lead"),
                       F.col("_block.tokens").alias("_tokens"), F.posexplode("_block.tokens").alias("_at", "_token"))
    own = at.where((F.col("_at") >= F.col("_lead")) & (F.col("_at") < F.col("_lead") + BLOCK_TOKENS))
    return own.select("_id", "_h", "_tokens", "_at", (F.col("_start") + F.col("_at") - F.col("_lead")).alias("_pos"))


def _needed(width: int) -> int:
    """Equal tokens that a match of so many aligned tokens has at least."""
    return width if width < LEAST_TOKENS else math.ceil(width * SHARE)


class _Benchmark:
    """The different items as words, the widths and masks that occur, and all seeds with a filter over them."""

    def __init__(self, benchmark: DataFrame, item_id: str, item_text: str):
        clean = F.filter(_tokens(text_or_empty(item_text)), lambda t: t != "")
        self.items = write_stage(benchmark.select(F.col(item_id).alias("item_id"), clean.alias("_words"))
                                 .where(F.size("_words") > 0)
                                 .select(F.monotonically_increasing_id().alias("_item"), "*"), "benchmark_items")
        widths = {r["n"] for r in self.items.select(F.least(F.lit(WINDOW), F.size("_words")).alias("n"))
                  .distinct().collect()}  # at most 13 rows
        self.widths = sorted(widths)
        self.masks = [k for k in range(len(_SEEDS)) if any(_serves(k, n) for n in widths | {WINDOW})]

        def seed(which: int) -> Column:
            _, least, most = _SEEDS[which]
            return F.when(F.size("_words").between(least, 2**31 - 1 if most is None else most),
                          _mask_hash("_words", "_at", which))

        placed = self.items.select("_item", "_words", F.posexplode("_words").alias("_at", "_word"))
        found = placed.select("_item", "_at", F.explode(F.array(*[seed(k) for k in self.masks])).alias("_hash"))
        self.seeds = write_stage(found.where("_hash IS NOT NULL"), "benchmark_seeds")
        self.members = Membership(self.seeds, "_hash", "benchmark_filter")

    def candidates(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """A row per document window and mask that may be a hit: ``_id, _h, _pos, _here, _nth`` of the masks, ``_seed``."""
        windows = _windows(docs.select(*row_key(id_col, text_col), _tokens(text_or_empty(text_col)).alias("_all")))
        for k in self.masks:
            windows = windows.withColumn(f"_hash{k}", _mask_hash("_tokens", "_at", k))
            windows = self.members.mark(windows, f"_hash{k}", f"_maybe{k}")
        seeds = F.array(*[F.when(F.col(f"_maybe{k}"), F.col(f"_hash{k}")) for k in self.masks])
        return (windows.where(" OR ".join(f"_maybe{k}" for k in self.masks))
                .select("_id", "_h", "_pos", _around("_tokens", "_at").alias("_here"), F.posexplode(seeds).alias("_nth", "_seed"))
                .where("_seed IS NOT NULL"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per contaminated document and benchmark item:
    ``doc_id, item_id, matched_tokens, first_token, hits`` and the document row's text hash ``_h``.

    ``matched_tokens`` is the most equal tokens in any aligned window of 13, at least 80 % of the window (of the item,
    if it is shorter, and all of an item of fewer than 8); ``first_token`` is where the first verified seed starts. Clean
    documents have no row. Texts of any length are searched whole, at a cost in proportion to their length. Null and
    empty texts match nothing. Repeated document rows share one result row, repeated items are reported by their ids;
    empty tables give no rows. Other columns are not read.
    """
    bench = _Benchmark(benchmark, item_id, item_text)
    hits = (bench.candidates(docs, id_col, text_col).join(bench.seeds, F.col("_seed") == F.col("_hash"))
            .join(bench.items, "_item")
            .select("_id", "_h", "item_id", "_pos", "_here", _around("_words", "_at").alias("_there"),
                    F.least(F.lit(WINDOW), F.size("_words")).alias("_width")))
    same = F.zip_with("_here", "_there", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    best = F.array_max(F.transform(
        F.sequence(F.lit(1), F.lit(_REACH + 1)),
        lambda s: F.aggregate(F.slice(F.col("_same"), s, F.lit(WINDOW)), F.lit(0), lambda x, y: x + y)))
    measured = hits.select("*", same.alias("_same")).select("*", best.alias("_best"))
    need = F.when(F.col("_width") < LEAST_TOKENS, F.col("_width")).otherwise(F.ceil(F.col("_width") * SHARE))
    enough = F.when(F.col("_best") >= need, F.col("_pos"))
    return (measured.select("*", enough.alias("_sound")).groupBy("_id", "_h", "item_id")
            .agg(F.max("_best").alias("matched_tokens"), F.min("_sound").alias("first_token"),
                 F.count("_sound").alias("hits"))
            .where("hits > 0").withColumnRenamed("_id", "doc_id"))


def _flat(arrays: list[Column]) -> Column:
    """The values of all arrays, of which some are null."""
    return F.flatten(F.array_compact(F.array(*arrays)))


def _window(tokens: Column, width: int) -> Callable[[Column], Column]:
    return lambda start: F.struct(F.lit(width).alias("width"), F.slice(tokens, start, F.lit(width)).alias("words"))


def _own_windows(widths: list[int]) -> Column:
    """All windows of an item, of 13 words or of the whole item, if it is shorter."""
    n = F.size("_words")
    return _flat([F.when(F.least(F.lit(WINDOW), n) == w,
                         F.transform(F.sequence(F.lit(1), F.greatest(n - w + 1, F.lit(1))), _window(F.col("_words"), w))) for w in widths])


def _windows_of(width: int) -> Column:
    """The windows of so many tokens that hold the hit at the middle of ``_here``, as structs of width and tokens."""
    first = 1 - width + min(mask[-1] for k, (mask, *_) in enumerate(_SEEDS) if _serves(k, width))
    starts = F.sequence(F.lit(WINDOW + first), F.lit(WINDOW))
    known = F.transform("_here", lambda t: F.coalesce(t, F.lit("")))  # equals no token of an item
    return F.transform(starts, _window(known, width))


def _forms(windows: DataFrame) -> DataFrame:
    """Add the forms of ``_window`` (a struct of width and words): ``_form, _form2``, two hashes for 96 bits."""
    def left_out(width: int) -> Column:
        picks = itertools.combinations(range(width), width - _needed(width))
        return F.array(*[F.array(*[F.lit(p) for p in pick]).cast("array<int>") for pick in picks])

    widths = F.create_map(*[c for w in range(1, WINDOW + 1) for c in (F.lit(w), left_out(w))])
    picked = windows.select("_window", F.explode(widths[F.col("_window.width")]).alias("_out"))
    words = F.transform("_window.words", lambda t, i: F.when(~F.array_contains("_out", i), t))
    rest = picked.select("_window", "_out", F.concat(F.array(F.col("_window.width").cast("string")), words).alias("_rest"))
    return rest.select("_window", F.xxhash64("_out", "_rest").alias("_form"), F.hash("_out", "_rest").alias("_form2"))


def leaking(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents of ``contaminated``, each row key (``_id, _h``) once, in time linear in documents and items.

    Nulls, empty and very long texts, repeated rows and empty tables are as there.
    """
    bench = _Benchmark(benchmark, item_id, item_text)
    if not bench.widths:
        return docs.select(*row_key(id_col, text_col)).limit(0)
    items = bench.items.select(F.explode(_own_windows(bench.widths)).alias("_window")).distinct()
    forms = write_stage(_forms(items).select("_form", "_form2").distinct(), "benchmark_forms")
    known = Membership(forms, "_form", "benchmark_forms_filter")

    hit = bench.seeds.select(F.col("_hash").alias("_seed")).distinct()
    around = _flat([F.when(F.col("_nth").isin([n for n, k in enumerate(bench.masks) if _serves(k, w)]), _windows_of(w))
                    for w in bench.widths])
    key = [F.xxhash64("_window").alias("_key"), F.hash("_window").alias("_key2")]  # 96 bits stand for a window
    near = write_stage(bench.candidates(docs, id_col, text_col).join(hit, "_seed", "left_semi")
                       .select("_id", "_h", F.explode(around).alias("_window")).select("*", *key), "document_windows")
    tried = known.mark(_forms(near.select("_window").distinct()), "_form", "_maybe").where("_maybe")
    sound = write_stage(tried.join(forms, ["_form", "_form2"], "left_semi").select(*key).distinct(), "sound_windows")
    return near.select("_id", "_h", "_key", "_key2").join(sound, ["_key", "_key2"], "left_semi").select("_id", "_h").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark; columns unchanged.

    Null, empty and very long texts, repeated rows and empty tables are as in ``contaminated``; null ids stay apart by
    their texts. Other columns, whatever their names, are passed on.
    """
    return drop_rows(docs, leaking(docs, benchmark, id_col, text_col), id_col, text_col)
