"""Documents in blocks of bounded bytes, and the exchange of hashed keys between blocks and buckets.

Some operators must know, for every position of a text, whether its key (a hash of what stands there) also occurs
elsewhere. That set of keys grows with the input, so it is never broadcast. Instead each block sends its different keys
to buckets (a row a bucket, keys packed side by side), a bucket decides over all blocks that hold a key, and answers
only those. A key that a third of all rows hold is sent once a block. The answers meet the block's texts again through
``cogroup``; both uses of the blocks are one exchange, which Spark reuses within a query.

The numbers of blocks and buckets follow the input's bytes, so that a group's size does not grow with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
#: Text bytes whose keys fall into one bucket.
BUCKET_BYTES = 4 << 20
#: What a row costs beside its text.
ROW_BYTES = 64


def input_bytes(docs: DataFrame, text: Column) -> int:
    """Bytes of all texts, and ``ROW_BYTES`` a row."""
    return docs.agg(F.sum(F.octet_length(text).cast("long") + ROW_BYTES)).first()[0] or 0


def blocked(docs: DataFrame, columns: list[Column], total: int, parts: int = 1) -> DataFrame:
    """``columns`` with ``_row`` (a unique long) and ``_block``, exchanged once so that a block lies in one partition.

    Rows are dealt out in turn, whatever they hold, so no key or copy can make a block large. ``parts`` makes blocks
    smaller by that factor.
    """
    blocks = max(1, -(-total * parts // BLOCK_BYTES))
    return (docs.select(*columns, F.monotonically_increasing_id().alias("_row"))
            .withColumn("_block", F.pmod(F.col("_row"), F.lit(blocks))).repartition(blocks, "_block"))


def bucket_bits(total: int) -> int:
    """The number of buckets as a power of two."""
    return max(4, min(24, (max(1, total) // BUCKET_BYTES).bit_length()))


def binary_rows(bounds: np.ndarray, records: np.ndarray) -> pa.Array:
    """A binary value for each range between ``bounds`` of a two-dimensional byte array."""
    width = records.shape[1]
    offsets = pa.array((bounds * width).astype(np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1,
                                 [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(records))]
                                 ).cast(pa.binary())


def records_of(payloads: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte records of all payloads one after the other, and how many each payload holds."""
    whole = [p for p in payloads.to_pylist()]
    counts = np.array([len(p) // width for p in whole], np.int64)
    return np.frombuffer(b"".join(whole), np.uint8).reshape(-1, width), counts


def packed_columns(columns: list[np.ndarray]) -> bytes:
    """Arrays of equal length one after the other, compressed: columns shrink much better than rows."""
    return pa.compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns), codec="zstd", asbytes=True)


def unpacked_columns(payload: bytes, n: int, kinds: list[str | tuple[str, int]]) -> list[np.ndarray]:
    """The ``n`` rows of each array of ``packed_columns``; a kind is a type, or a type and how many a row has."""
    shapes = [(np.dtype(k), ()) if isinstance(k, str) else (np.dtype(k[0]), (k[1],)) for k in kinds]
    sizes = [n * t.itemsize * int(np.prod(shape)) for t, shape in shapes]
    data = pa.decompress(payload, decompressed_size=sum(sizes), codec="zstd", asbytes=True) if n else b""
    out, at = [], 0
    for (t, shape), size in zip(shapes, sizes, strict=True):
        out.append(np.frombuffer(data, t, size // t.itemsize, at).reshape(n, *shape))
        at += size
    return out


class KeyPacking:
    """The leading ``bits + kept`` bits of 64-bit keys, grouped by their first ``bits``, with ``extra`` bits beside each.

    Cutting a key short can only make different keys look alike, so what follows must check the real thing.
    """

    def __init__(self, bits: int, kept: int, extra: int):
        self.bits, self.kept, self.extra = bits, kept, extra
        self.width = -(-(kept + extra) // 8)

    def short(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.bits - self.kept)

    def pack(self, short: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Ascending ``short`` keys to the buckets that occur and a payload for each."""
        bucket = (short >> np.uint64(self.kept)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.empty(0, np.int64)
        low = short & np.uint64((1 << self.kept) - 1)
        value = (low << np.uint64(self.extra)) | beside.astype(np.uint64)
        octets = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :self.width]
        return bucket[starts], binary_rows(np.append(starts, len(short)), octets)

    def unpack(self, buckets: np.ndarray, payloads: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Short keys, what stands beside them, and how many each payload holds."""
        octets, counts = records_of(payloads, self.width)
        whole = np.zeros((len(octets), 8), np.uint8)
        whole[:, :self.width] = octets
        value = whole.view("<u8").reshape(-1).astype(np.uint64)
        short = (np.repeat(buckets.astype(np.uint64), counts) << np.uint64(self.kept)) | (value >> np.uint64(self.extra))
        return short, value & np.uint64((1 << self.extra) - 1), counts


class GapPacking(KeyPacking):
    """The same, with the gaps between ascending keys in place of the keys: their upper bytes are mostly zero and vanish.

    A payload is the number of its keys and the compressed bytes of its gaps, all lowest bytes first.
    """

    def pack(self, short: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        bucket = (short >> np.uint64(self.kept)).astype(np.int64)
        low = short & np.uint64((1 << self.kept) - 1)
        value = (low << np.uint64(self.extra)) | beside.astype(np.uint64)
        starts = runs(bucket)
        gap = np.diff(value, prepend=np.uint64(0))
        gap[starts] = value[starts]
        planes = gap.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :self.width]
        return bucket[starts], pa.array([(hi - lo).to_bytes(4, "little") + packed_columns([planes[lo:hi].T])
                                         for lo, hi in ranges(starts, len(short))], pa.binary())

    def unpack(self, buckets: np.ndarray, payloads: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, counts = [np.empty(0, np.uint64)], []
        for payload in payloads.to_pylist():
            n = int.from_bytes(payload[:4], "little")
            planes = np.frombuffer(pa.decompress(payload[4:], n * self.width, codec="zstd", asbytes=True), np.uint8)
            whole = np.zeros((n, 8), np.uint8)
            whole[:, :self.width] = planes.reshape(self.width, n).T
            values.append(np.cumsum(whole.view("<u8").reshape(-1), dtype=np.uint64))
            counts.append(n)
        value, counts = np.concatenate(values), np.array(counts, np.int64)
        short = (np.repeat(buckets.astype(np.uint64), counts) << np.uint64(self.kept)) | (value >> np.uint64(self.extra))
        return short, value & np.uint64((1 << self.extra) - 1), counts


def runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values of an ordered array starts."""
    if not len(ordered):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def ranges(starts: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The ranges between ``starts``, the last one up to ``n``; none without a start."""
    return list(zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True)) if len(starts) else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (two multiply and shift steps)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
