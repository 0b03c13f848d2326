"""Operator 8, sharding by histogram sort, with DataFrame operations only.

Documents are laid out in key order (the id; rows of one id by a tie key) and cut into shards of equal bytes. Splitters
are found without sorting: each round counts the exact bytes that lie below a few thousand candidate boundaries, over
all rows, and keeps for every splitter the one interval its target falls into. Rounds go on until an interval is a
single key, or its bytes are within the tolerance. Then the rows are exchanged once.

Every count is a partial aggregate onto at most ``PROBES`` rows, which is all that reaches the driver. A key that
holds many rows (an id that a third of all rows share) is cut by a second search over the tie key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entryclime.llm.common import text_or_empty
from entryclime.session import write_stage

ROW_OVERHEAD = 16
PROBES = 4096
#: Pieces of a shard that are numbered apart, so that no task sorts a whole shard.
PIECES = 32


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Narrow rows ``doc_id, size, text_crc32, _key, _tie`` for the search; the text is read here only."""
    text = text_or_empty(text_col).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32")
                       ).select("*", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_key"),
                                F.monotonically_increasing_id().alias("_tie"))


def _step_of(values: list[int], column: Column) -> Column:
    """How many of the sorted ``values`` are at or below ``column``."""
    at = F.lit(0)
    for v in values:
        at = at + (column >= F.lit(v)).cast("int")
    return at


def _search(rows: DataFrame, column: str, bounds: tuple[int, int], targets: list[int], tolerance: int
            ) -> list[tuple[int, int]]:
    """For each target, the key in ``bounds`` whose rows reach it and the exact bytes below that key.

    That key is the last one with at most ``target`` bytes below it; a splitter within ``tolerance`` bytes under its
    target is taken at once.
    """
    found: list[tuple[int, int] | None] = [None] * len(targets)
    spans = {i: (bounds[0], bounds[1], 0) for i in range(len(targets))}  # low, high (exclusive), bytes below low
    while spans:
        distinct = sorted(set(spans.values()))
        steps = max(2, PROBES // len(distinct))
        widths = [max(1, -(-(high - low) // steps)) for low, high, _ in distinct]
        which = _step_of([low for low, _, _ in distinct], F.col(column)) - 1
        lows, highs, wide = (F.array(*[F.lit(x) for x in xs]) for xs in
                             ([s[0] for s in distinct], [s[1] - 1 for s in distinct], widths))
        lows, wide = lows.cast("array<decimal(20,0)>"), wide.cast("array<decimal(20,0)>")
        counted = (rows.where(F.col(column) >= distinct[0][0]).withColumn("_span", which)
                   .where(F.col(column) <= F.get(highs, F.col("_span")))
                   .select("_span", "size", F.get(lows, F.col("_span")).alias("_low"),
                           F.get(wide, F.col("_span")).alias("_wide"), F.col(column).alias("_at"))
                   .withColumn("_slot", F.expr("(cast(_at as decimal(20,0)) - _low) div _wide"))
                   .groupBy("_span", "_slot").agg(F.sum("size").alias("_bytes")).collect())
        histogram: dict[int, list[tuple[int, int]]] = {}
        for r in sorted(counted, key=lambda r: (r["_span"], r["_slot"])):
            histogram.setdefault(r["_span"], []).append((r["_slot"], r["_bytes"]))
        narrowed = {}
        for i, span in spans.items():
            k = distinct.index(span)
            low, high, below = span
            slot, under = 0, below
            for s, size in histogram.get(k, []):  # the last non-empty slot that starts at or below the target
                if below > targets[i]:
                    break
                slot, under = s, below
                below += size
            start = low + slot * widths[k]
            end = min(high, start + widths[k])
            if end - start <= 1 or 0 <= targets[i] - under <= tolerance:
                found[i] = (start, under)
            else:
                narrowed[i] = (start, end, under)
        spans = narrowed
    return [x for x in found if x is not None]


def splitters(rows: DataFrame, shards: int, tolerance: int = 0) -> list[tuple[int, int]]:
    """The first (key, tie) of shards 1 to ``shards - 1``: the first row whose middle reaches its share of the bytes.

    With tolerance 0 that is exact; else a boundary may lie up to ``tolerance`` bytes early.
    """
    span = rows.agg(F.min("_key").alias("lo"), F.max("_key").alias("hi"), F.sum("size").alias("total")).first()
    if span["total"] is None:
        return []
    doubled = [-(-2 * span["total"] * j // shards) for j in range(1, shards)]
    targets = [d // 2 for d in doubled]
    at = _search(rows, "_key", (span["lo"], span["hi"] + 1), targets, tolerance)
    held = {r["_key"]: r for r in rows.where(F.col("_key").isin([k for k, _ in at])).groupBy("_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("_tie").alias("lo"),
        F.max("_tie").alias("hi")).collect()}
    cuts: dict[int, tuple[int, int]] = {}
    least = -(1 << 63)
    crowded: dict[int, list[int]] = {}
    for j, (key, under) in enumerate(at):
        here = held.get(key)  # None: no row has this key, and the bytes below it are the target
        if here is None or targets[j] - under <= tolerance:
            cuts[j] = (key, least)
        elif here["n"] == 1:
            cuts[j] = (key, least) if 2 * under + here["bytes"] >= doubled[j] else (key + 1, least)
        else:
            crowded.setdefault(key, []).append(j)
    for key, own in crowded.items():
        under, same = at[own[0]][1], rows.where(F.col("_key") == key)
        found = _search(same, "_tie", (held[key]["lo"], held[key]["hi"] + 1), [targets[j] - under for j in own], tolerance)
        sizes = {r["_tie"]: r["size"] for r in same.where(F.col("_tie").isin([t for t, _ in found])).collect()}
        for j, (tie, below) in zip(own, found, strict=True):
            reached = targets[j] - under - below <= tolerance or 2 * (under + below) + sizes.get(tie, 0) >= doubled[j]
            cuts[j] = (key, tie if reached else tie + 1)
    return [cuts[j] for j in range(len(at))]


def _at_or_after(cut: tuple[int, int]) -> Column:
    key, tie = cut
    return (F.col("_key") > key) | ((F.col("_key") == key) & (F.col("_tie") >= tie))


def assign_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                  tolerance: int = 0) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, by the law ``bytes``.

    ``size`` is the text's UTF-8 bytes plus 16; a null text has none and the checksum of an empty one. Null ids come
    first; rows of one id lie side by side. Shards follow key order, and a document goes to the shard in which its
    middle falls, so a shard is at most one largest document (plus ``tolerance``) off an equal share. ``slot`` counts from 0
    in a shard without gaps, in key order. ``grown_shard`` belongs to another law and is null. An empty table
    gives no rows; other columns are not read.
    """
    rows = write_stage(measured(docs, id_col, text_col), "shard_rows")
    cuts = splitters(rows, shards, tolerance)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + _at_or_after(cut).cast("int")
    placed = rows.withColumn("shard", shard.cast("int"))
    # The one exchange: rows go out by (shard, piece); pieces are key ranges inside a shard, of bounded number.
    edges = placed.groupBy("shard").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))
    placed = placed.join(F.broadcast(edges), "shard").withColumn(
        "_piece", F.expr(f"int((cast(_key as decimal(20,0)) - _lo) * {PIECES} div (cast(_hi as decimal(20,0)) - _lo + 1))"))
    counts = placed.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("shard", "_piece", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    order = Window.partitionBy("shard", "_piece").orderBy("_key", "_tie")
    return (placed.join(F.broadcast(before), ["shard", "_piece"])  # at most shards * PIECES rows
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("_before") + F.row_number().over(order) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
