"""Operator 5, SimHash near-dedup by anchor-point covering.

Fingerprints are compared only where they meet an anchor. The anchors are the words of the binary Golay code on 23 of
the 64 bits: a perfect code whose covering radius is 3, so every fingerprint has exactly one anchor within 3 bits, its
home. Two fingerprints that differ in at most t bits differ in at most t of these 23, so the second lies within 3 + t
bits of the first one's home. Each fingerprint is therefore replicated to every anchor within 3 + t (about 22 of 4096
for t = 2), and an anchor compares its homes with all its visitors over the whole 64 bits.

An anchor that gathers more than ``TILE`` rows is refined by the same code on the next 23 bits (a row that already
spent some of t on the first block has only the rest left), which splits it into 4096; what is still large is
compared in tiles. No list of partners is capped. An anchor returns a spanning forest of its links, never all pairs,
and copies of a text collapse to one fingerprint before any of this.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import keep_chosen, row_key, text_or_empty
from entryclime.llm.components import components
from entryclime.session import write_stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CODE_BITS, RADIUS = 23, 3
#: Fixed value: a generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GOLAY = 0b101011100011
TILE = 16_384
BLOCK_BYTES = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ------------------------------------------------------------------ fingerprints
def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a few megabytes at a time."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, min(at + BLOCK_BYTES, len(data)))
        end = cut.end() if cut else len(data)
        yield data[at:end].split()
        at = end


def _shingle_hashes(text: str, width: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles, repeats included; of the whole sequence if it is shorter than a shingle."""
    carried: list[bytes] = []
    total = 0
    for words in _word_blocks(text.encode().lower()):  # bytes.lower() touches A-Z only
        words = carried + words
        got = [xxhash.xxh64_intdigest(b" ".join(s), SEED)
               for s in zip(*(itertools.islice(words, i, None) for i in range(width)), strict=False)]
        total += len(got)
        yield np.array(got, np.uint64)
        carried = words[max(0, len(words) - width + 1):]
    if not total and carried:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], np.uint64)


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprints_of(texts: list[str], width: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit fingerprints: a bit is set if it is set in more than half of a text's shingle hashes."""
    counts = np.zeros((len(texts), 64), np.int64)
    sizes = np.zeros(len(texts), np.int64)

    def add(held: list[tuple[int, np.ndarray]]) -> None:
        owners = np.array([i for i, _ in held])
        local, slot = np.unique(owners, return_inverse=True)
        owner = np.repeat(slot, [len(h) for _, h in held])
        octets = np.concatenate([h for _, h in held]).astype("<u8").view(np.uint8).reshape(-1, 8)
        for b in range(8):  # a histogram of byte values per text, turned into bit counts
            seen = np.bincount(owner * 256 + octets[:, b], minlength=len(local) * 256).reshape(-1, 256)
            counts[local, b * 8:b * 8 + 8] += seen @ _BITS
        sizes[local] += np.bincount(owner, minlength=len(local))

    held, size = [], 0
    for i, text in enumerate(texts):
        for hashes in _shingle_hashes(text, width):
            held.append((i, hashes))
            size += len(hashes)
            if size > 400_000 or len(held) > 2000:
                add(held)
                held, size = [], 0
    if held:
        add(held)
    set_bits = counts * 2 > sizes[:, None]
    return (set_bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


# ------------------------------------------------------------------ anchors
def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.uint32).copy()
    for bit in range(CODE_BITS - 1, 10, -1):
        rest ^= np.where((rest >> bit) & 1, np.uint32(GOLAY << (bit - 11)), np.uint32(0))
    return rest


@functools.lru_cache(maxsize=8)
def _patterns(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of at most ``reach`` bits ordered by syndrome: patterns, their weights, where a syndrome starts."""
    errors = np.array([sum(1 << b for b in c) for n in range(reach + 1)
                       for c in itertools.combinations(range(CODE_BITS), n)], np.uint32)
    syndrome = _syndromes(errors)
    order = np.argsort(syndrome, kind="stable")
    return errors[order], np.bitwise_count(errors[order]), np.searchsorted(syndrome[order], np.arange(2049))


def anchors_of(words: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, distance) for every code word within ``reach`` bits of each 23-bit word."""
    errors, weights, starts = _patterns(reach)
    s = _syndromes(words)
    counts = starts[s + 1] - starts[s]
    rows = np.repeat(np.arange(len(words)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[s], counts)
    return rows, words.astype(np.uint32)[rows] ^ errors[at], weights[at]


ANCHORED = "anchor long, fp long, spare int, home boolean"


def _expand(block: int, max_bits: int):
    """Rows ``anchor, fp, spare, home`` to the rows of the anchors of one 23-bit block within their reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                part = batch.slice(start, 20_000)
                above, fp, spare, home = (c.to_numpy(zero_copy_only=False) for c in part.columns)
                words = ((fp.view(np.uint64) >> np.uint64(CODE_BITS * block)) & np.uint64((1 << CODE_BITS) - 1))
                for left in range(max_bits + 1):
                    own = np.flatnonzero(spare == left)
                    rows, anchor, distance = anchors_of(words[own].astype(np.uint32), RADIUS + left)
                    rows = own[rows]
                    yield pa.RecordBatch.from_arrays([
                        pa.array((above[rows] << CODE_BITS) | anchor.astype(np.int64)), pa.array(fp[rows]),
                        pa.array(left - np.maximum(distance.astype(np.int32) - RADIUS, 0), pa.int32()),
                        pa.array(home[rows] & (distance <= RADIUS))], ["anchor", "fp", "spare", "home"])
    return run


def _forest(max_bits: int):
    """Links between an anchor's (or a tile's) homes and visitors, as a spanning forest ``u, v``."""
    def run(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        is_home, is_visitor = (group.column(c).to_numpy() for c in ("home", "visitor"))
        fps = np.unique(fp)
        homes, visitors = np.unique(fp[is_home]), np.unique(fp[is_visitor])
        at = np.searchsorted(fps, visitors)
        label = np.arange(len(fps))
        edges = []
        step = max(1, 2_000_000 // max(1, len(visitors)))
        for start in range(0, len(homes), step):
            some = homes[start:start + step]
            near = np.bitwise_count(some[:, None] ^ visitors[None, :]) <= max_bits
            for i in np.flatnonzero(near.sum(axis=1) > (np.isin(some, visitors))):
                own = np.searchsorted(fps, some[i])
                roots = np.unique(label[np.append(at[near[i]], own)])
                if len(roots) > 1:
                    for r in roots[roots != label[own]]:
                        edges.append((some[i], fps[r]))
                    label[np.isin(label, roots)] = roots[0]
        u, v = (np.array([e[k] for e in edges], np.uint64).view(np.int64) for k in (0, 1))
        return pa.table({"u": u, "v": v})
    return run


def links(nodes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Edges ``u, v`` that join exactly the fingerprints (column ``fp``, distinct longs) linked by steps of ``max_bits``."""
    rows = nodes.select(F.lit(0).cast("long").alias("anchor"), "fp", F.lit(max_bits).alias("spare"),
                        F.lit(True).alias("home"))
    rows = write_stage(rows.mapInArrow(_expand(0, max_bits), ANCHORED), "simhash_anchors")

    def load_of(rows: DataFrame) -> DataFrame:
        """Anchors that have a home and a second row, and how many tiles each needs."""
        return write_stage(
            rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.max("home").alias("_any"))
            .where("_any AND _n > 1").select(F.col("anchor").alias("_a"),
                                             F.ceil(F.col("_n") / tile).cast("int").alias("_tiles")), "simhash_load")

    load = load_of(rows)
    loaded = rows.join(F.broadcast(load), F.col("anchor") == F.col("_a")).drop("_a")  # at most 4096 anchors
    parts = [loaded.where("_tiles = 1")]
    if not load.where("_tiles > 1").isEmpty():
        finer = write_stage(loaded.where("_tiles > 1").select("anchor", "fp", "spare", "home")
                            .mapInArrow(_expand(1, max_bits), ANCHORED), "simhash_fine_anchors")
        # up to 4096 squared: two tables read anew, so a crowded anchor's partition can be split
        parts.append(finer.join(load_of(finer), F.col("anchor") == F.col("_a")).drop("_a"))
    found = []
    for part in parts:
        n = F.col("_tiles")
        mine = F.pmod(F.xxhash64("fp"), n).cast("int")
        other = F.explode(F.sequence(F.lit(0), n - 1))
        visits = part.select("anchor", other.alias("_i"), mine.alias("_j"), "fp",
                             ((n == 1) & F.col("home")).alias("home"), F.lit(True).alias("visitor"))
        stays = part.where(n > 1).where("home").select("anchor", mine.alias("_i"), other.alias("_j"), "fp",
                                                       F.lit(True).alias("home"), F.lit(False).alias("visitor"))
        found.append(visits.unionByName(stays).groupBy("anchor", "_i", "_j")
                     .applyInArrow(_forest(max_bits), "u long, v long"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


# ------------------------------------------------------------------ documents
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``, the row's text hash ``_h`` and ``_group``.

    ``component_id`` is the smallest id reachable over links of at most ``max_bits`` differing bits. Null and empty
    texts have fingerprint zero, which links like any other. Null ids never are the smallest unless all are null.
    Unrelated components share it where their smallest ids are null or equal; ``_group``, the component's least
    fingerprint, tells them apart. Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    base = docs.select(*row_key(id_col, text_col), text_or_empty(text_col).alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = fingerprints_of(batch.column("_text").to_pylist(), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_h"), pa.array(fps)],
                                             ["_id", "_h", "fp"])

    marked = write_stage(base.mapInArrow(run, f"_id {id_type}, _h long, fp long"), "simhash_rows")
    nodes = write_stage(marked.groupBy("fp").agg(F.min("_id").alias("_least")), "simhash_nodes")
    roots = write_stage(components(links(nodes, max_bits), "simhash"), "simhash_roots")
    linked = roots.join(nodes, F.col("node") == F.col("fp"))
    least = linked.groupBy("root").agg(F.min("_least").alias("_first")).withColumnRenamed("root", "_root")
    grouped = linked.join(least, F.col("root") == F.col("_root")).select(F.col("node").alias("_node"), "_first", "_root")
    of_fp = write_stage(nodes.join(grouped, F.col("fp") == F.col("_node"), "left")
                        .select(F.col("fp").alias("_fp"), F.coalesce("_first", "_least").alias("component_id"),
                                F.coalesce("_root", "fp").alias("_group")), "simhash_components")
    return marked.join(of_fp, F.col("fp") == F.col("_fp"), "left").select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "_h", "_group")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, that of the smallest id; columns unchanged.

    A null id comes after all others. Of rows that repeat the id, the one with the smaller text hash stays; of rows
    that repeat id and text, one.
    """
    rows = write_stage(near_duplicates(docs, id_col, text_col, width, max_bits)
                       .select(F.col("doc_id").alias("_id"), "_h", "_group"), "simhash_verdict")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_h").alias("h")))
    groups = write_stage(rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
                         .where("_n > 1").withColumnRenamed("_group", "_of"), "simhash_groups")
    grouped = rows.join(groups, F.col("_group") == F.col("_of"))
    is_first = F.col("_id").eqNullSafe(F.col("_first.id")) & (F.col("_h") == F.col("_first.h"))
    return keep_chosen(docs, grouped.select("_id", "_h", is_first.alias("_stays")), id_col, text_col)
