"""Operator 11, vector code compression: every vector as one codebook index per part.

Vectors become integers and are cut into ``PARTS`` parts, each with a codebook of up to 64 entries. The nearest entry is
found by slices and bitmasks: in each dimension the entries' coordinates are sorted, and position i carries a 64-bit
mask of the first i entries. A radius around a part's coordinate selects a range of positions, whose entries are the
difference of two prefix masks; the masks of all dimensions ANDed leave the entries inside the cube. Every entry within
Euclidean ``radius`` lies in the cube, so if the best candidate is no farther than that, it is the nearest, ties
included. What a radius does not settle is tried again with twice the radius.

A round is one pass: tasks send partial sums per (part, entry), at most ``PARTS * ENTRIES`` rows, which is all that
the driver sees. Codebooks travel with the tasks; their size is fixed by the dimension.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import over_batches
from entryclime.session import write_stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Largest integer component: squares of differences, summed over a part, stay below 2^62.
LARGEST = 1 << 27
ROWS_AT_ONCE = 4096


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Kept rows as ``vec_id, label, v``: integers floor(256 * x), padded with zeros to a multiple of ``PARTS``."""
    x = F.col(vector_col).cast("array<double>")

    def whole(c: Column) -> Column:
        scaled = F.floor(c * F.lit(float(SCALE)))
        return F.when(F.abs(c) * SCALE < LARGEST, scaled).otherwise(
            F.raise_error(F.lit("a component is too large for exact distances")).cast("long"))

    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), x.alias("_x"))
    rows = rows.where(F.col("_x").isNotNull() & (F.size("_x") > 0)).where(
        F.forall("_x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    spare = F.pmod(-F.size("_x"), F.lit(PARTS))
    return rows.select("vec_id", "label", F.concat(F.transform("_x", whole),
                                                   F.array_repeat(F.lit(0).cast("long"), spare)).alias("v"))


class Nearest:
    """Exact nearest entries of one codebook by slices and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = [self.entries[order[:, d], d] for d in range(dims)]
        bits = np.uint64(1) << np.arange(n, dtype=np.uint64)
        self.prefix = [np.concatenate([np.zeros(1, np.uint64), np.bitwise_or.accumulate(bits[order[:, d]])])
                       for d in range(dims)]
        spread = max(1, int((entries.max(axis=0) - entries.min(axis=0)).max()))
        self.radius = max(1, int(spread / (2 * max(2, n) ** (1 / max(1, dims)))))

    def candidates(self, points: np.ndarray, radius: int) -> np.ndarray:
        """A mask of the entries inside the cube of ``radius`` around each point."""
        mask = np.full(len(points), ~np.uint64(0))
        for d, (coordinates, prefix) in enumerate(zip(self.sorted, self.prefix, strict=True)):
            below = np.searchsorted(coordinates, points[:, d] - radius, "left")
            upto = np.searchsorted(coordinates, points[:, d] + radius, "right")
            mask &= prefix[upto] ^ prefix[below]
        return mask

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry, the lowest index of equals."""
        index, distance = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        open_, radius = np.arange(len(points)), self.radius
        while len(open_):
            mask = self.candidates(points[open_], radius)
            bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, entry = np.nonzero(bits)
            settled = np.zeros(len(open_), bool)
            if len(row):
                apart = points[open_[row]] - self.entries[entry]
                squared = (apart * apart).sum(axis=1)
                starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                least = np.minimum.reduceat(squared, starts)
                # entries ascend within a row, so the first that reaches the least is the lowest index
                first = np.flatnonzero(squared == np.repeat(least, np.diff(np.append(starts, len(row)))))
                first = first[np.concatenate([[True], row[first][1:] != row[first][:-1]])]
                at = row[starts]
                sure = least <= radius * radius
                settled[at[sure]] = True
                index[open_[at[sure]]], distance[open_[at[sure]]] = entry[first][sure], least[sure]
            open_, radius = open_[~settled], radius * 2
        return index, distance


def _parts_of(column: pa.Array, books: list[np.ndarray]) -> np.ndarray | None:
    """Vectors of the codebooks' dimension as rows x parts x components."""
    width = books[0].shape[1]
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, len(books), width)


def _sums(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = [Nearest(b) for b in books]
        n, width = books[0].shape
        sums, counts = np.zeros((len(books), n, width), np.int64), np.zeros((len(books), n), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                points = _parts_of(batch.column(0).slice(start, ROWS_AT_ONCE), books)
                for p, near in enumerate(nearest):
                    index, _ = near(points[:, p])
                    np.add.at(sums[p], index, points[:, p])
                    counts[p] += np.bincount(index, minlength=n)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
                                          pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
                                         ["part", "entry", "n", "sums"])
    return run


def _refined(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: every used entry becomes the floored mean of its parts."""
    partial = rows.select("v").mapInArrow(_sums(books), "part long, entry long, n long, sums array<long>")
    width = books[0].shape[1]
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(width)]).alias("sums"))
    books = [b.copy() for b in books]
    for r in totals.collect():  # at most PARTS * ENTRIES rows
        books[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def learn_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
                    ) -> list[np.ndarray]:
    """A codebook a part, from the ``entries`` smallest ids (nulls last, ties by the vector), refined ``rounds`` times."""
    seeds = [r["v"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()]
    if not seeds:
        return []
    whole = np.array([s for s in seeds if len(s) == len(seeds[0])], np.int64).reshape(-1, parts, len(seeds[0]) // parts)
    books = [whole[:, p].copy() for p in range(parts)]
    same = rows.where(F.size("v") == len(seeds[0]))
    for _ in range(rounds):
        books = _refined(same, books)
    return books


def codebooks_text(books: list[np.ndarray]) -> str:
    """All components of all entries, by part, entry and position, as decimal integers joined by commas."""
    return ",".join(str(int(c)) for book in books for entry in book for c in entry)


def compress(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id, label, code, error`` for every quantised row of the codebooks' dimension."""
    fields = rows.schema
    schema = f"vec_id {fields['vec_id'].dataType.simpleString()}, label {fields['label'].dataType.simpleString()}, code string, error long"
    if not books:
        return rows.sparkSession.createDataFrame([], schema)
    width = books[0].shape[1]
    hexes = np.array([f"{i:02x}" for i in range(ENTRIES)])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, errors = [], []
        nearest = [_nearest(b.tobytes(), b.shape) for b in books]
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            points = _parts_of(batch.column(2).slice(start, ROWS_AT_ONCE), books)
            code, error = np.empty(points.shape[:2], np.int64), np.zeros(len(points), np.int64)
            for p, near in enumerate(nearest):
                code[:, p], distance = near(points[:, p])
                error += distance
            codes += ["".join(row) for row in hexes[code]]
            errors.append(error)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()),
                                           pa.array(np.concatenate(errors))], ["vec_id", "label", "code", "error"])

    return rows.where(F.size("v") == len(books) * width).select("vec_id", "label", "v").mapInArrow(over_batches(run), schema)


@functools.lru_cache(maxsize=4 * PARTS)
def _nearest(data: bytes, shape: tuple[int, int]) -> Nearest:
    return Nearest(np.frombuffer(data, np.int64).reshape(shape))


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
                 ) -> DataFrame:
    """One row per kept vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    Rows whose vector is null, empty, or holds a null or non-finite component are dropped, and so are vectors of another
    padded length than that of the smallest kept id (there is one codebook). Lengths are padded with zeros to a multiple
    of 16. Components of 2^19 and more raise an error, as their distances would not be exact. With fewer than 64 kept
    rows the codebooks have that many entries. Null ids are kept and come last; repeated rows give repeated results;
    an empty table gives none. ``label_error`` sums the error over equal labels, null being one. Other columns are not read.
    """
    rows = write_stage(quantised(vectors, id_col, vector_col, label_col), "vector_rows")
    books = learn_codebooks(rows)
    coded = write_stage(compress(rows, books), "vector_codes")
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
