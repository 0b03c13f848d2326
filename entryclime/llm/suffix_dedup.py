"""Operator 12, suffix-array dedup: remove every byte of a repeated passage but in the smallest document that holds it.

A passage is ``LENGTH`` bytes. The suffixes that matter are sorted to that depth by deep-shallow sorting: multikey
quicksort on characters of 8 bytes to a shallow depth, then blind tries for the groups that share it. Equal passages
then lie side by side, and all but those of the smallest document id are removed.

Which suffixes matter is found first, since most passages are unique. The anchor of a passage is its least-hashed
substring of ``ANCHOR`` bytes (the leftmost of equals), which equal passages share at the same place. An anchor serves
all consecutive passages that it is least in, so about one byte in sixteen starts an anchor.

1. Each block of documents sends its different anchor hashes to buckets, which answer those that several documents hold
   (``blocks.py``).
2. A block sends the surroundings of the answered anchors, once for copies in the block, to buckets by anchor. A bucket
   is one text; its suffixes are those that an anchor serves. Surroundings that a block holds again under a larger id
   are known to go and are not sent. An anchor that occurs very often is split by passage instead.
3. The passages that must go meet their blocks, which cut the texts.

The blocks are exchanged once; copies of a text, of a passage or of an anchor cost a bucket one record a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.llm.blocks import (KeyPacking, blocked, bucket_bits, input_bytes, mixed, packed_columns, ranges, runs,
                                   unpacked_columns)

LENGTH = 50
ANCHOR = 20
#: Passages that one anchor can serve: the places of an anchor in a passage.
PLACES = LENGTH - ANCHOR + 1
#: Bytes around an anchor that its passages reach: ``PLACES - 1`` before it, ``LENGTH`` from it on.
AROUND = PLACES - 1 + LENGTH
#: A context and the first and last place served, in whole 8-byte words.
CONTEXT_BYTES = -(-(AROUND + 2) // 8) * 8
#: Bytes that one pass of array operations takes; positions in it must fit ``_PLACE_BITS``.
SEGMENT_BYTES = 1 << 20
_PLACE_BITS = 21
#: Occurrences of an anchor from which its passages are sent apart.
CROWDED = 1 << 14
SHALLOW = 2
SMALL = 1 << 12
_BASE = 0x9E3779B97F4A7C15

#: The columns of what is exchanged by kind: contexts (bytes, first and last place, id) and, on their way back, masks of
#: places; ranges of passages that must go; the members of a context.
CONTEXT, MASK = [("u1", AROUND), "u1", "u1", "<i8"], ["<i4", "<u8"]
VICTIM, MEMBER = ["<i4", "<i8", "<i8"], ["<i4", "<i4", "<i8"]
PASSED = "bucket int, block long, kind int, first int, n int, payload binary"
RETURNED = "block long, kind int, n int, payload binary"


# ------------------------------------------------------------------ anchors
def _substring_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every substring of ``width`` bytes, by doubling."""
    whole, have, part, step, power = None, 0, codes.astype(np.uint64) + np.uint64(1), 1, np.uint64(_BASE)
    with np.errstate(over="ignore"):
        while width:
            if width & 1:
                n = len(part) - have
                whole = part if whole is None else whole[:n] * power + part[have:have + n]
                have += step
            width >>= 1
            if width:
                part = part[:-step] * power + part[step:]
                power, step = power * power, step * 2
    return mixed(whole)


def _segments(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side: bytes, and for each part its row, where it starts here and where in its text.

    A long text comes in parts that overlap by all but one byte of a passage, so each passage lies in one part only.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), SEGMENT_BYTES):
            part = text[at:at + SEGMENT_BYTES + LENGTH - 1]
            if held and size + len(part) > SEGMENT_BYTES:
                yield _beside(held)
                held, size = [], 0
            held.append((part, row, at))
            size += len(part)
    if held:
        yield _beside(held)


def _beside(held: list[tuple[bytes, int, int]]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(p) for p, _, _ in held])
    rows, ats = (np.array([h[k] for h in held], np.int64) for k in (1, 2))
    return b"".join(p for p, _, _ in held), rows, np.concatenate([[0], ends]), ats


def anchors(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all passages of parts side by side: position, first and last passage served, hash.

    ``ends`` is 0 and the end of every part. No passage crosses parts.
    """
    codes = np.frombuffer(data, np.uint8)
    hashes = _substring_hashes(codes, ANCHOR)
    places = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least, size = (hashes & ~low) | places, 1
    while size * 2 <= PLACES:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < PLACES:
        spare = PLACES - size
        least = np.minimum(least[:-spare], least[spare:])
    at = (least & low).astype(np.int64)
    inside = np.ones(len(at), bool)
    for end in ends[1:-1].tolist():  # passages that would run past the end of a part
        inside[max(0, end - LENGTH + 1):end] = False
    at = np.where(inside, at, -1)
    starts = runs(at)
    stops = np.append(starts[1:], len(at)) - 1
    real = at[starts] >= 0
    starts, stops = starts[real], stops[real]
    return at[starts], starts, stops, mixed(hashes[at[starts]])  # least hashes are small, so spread them again


def _block_rows(table: pa.Table) -> tuple[pa.Table, list[bytes], np.ndarray]:
    """A block's rows in the order of ``_row``, their texts, and their ids with null as the smallest."""
    table = table.sort_by("_row")
    ids = table.column("_order").to_numpy()
    return table, table.column("text").to_pylist(), ids


def _announce(packing: KeyPacking):
    """A block's different anchors to their buckets, each with whether several ids hold it and how often it occurs."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        _, texts, ids = _block_rows(table)
        shorts, owners = [], []
        for data, rows, ends, _ in _segments(texts):
            at, _, _, hashes = anchors(data, ends)
            shorts.append(packing.short(hashes))
            owners.append(ids[rows[np.searchsorted(ends, at, "right") - 1]])
        short, owner = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((shorts, np.uint64), (owners, np.int64)))
        order = np.argsort(short, kind="stable")
        short, owner = short[order], owner[order]
        starts = runs(short)
        bucket, payload = [], pa.array([], pa.binary())
        if len(starts):
            several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
            often = np.ceil(np.log2(np.diff(np.append(starts, len(short))))).astype(np.uint64)
            bucket, payload = packing.pack(short[starts], often | (several.astype(np.uint64) << np.uint64(7)))
        return pa.table({"bucket": pa.array(bucket, pa.int32()), "block": pa.array([key[0].as_py()] * len(bucket), pa.int64()),
                         "payload": payload})
    return run


def _answer(packing: KeyPacking):
    """The anchors of a bucket that several ids or blocks hold, to those blocks, each with whether it is crowded."""
    def run(table: pa.Table) -> pa.Table:
        buckets, blocks = table.column("bucket").to_numpy(), table.column("block").to_numpy()
        short, beside, counts = packing.unpack(buckets, table.column("payload"))
        held = np.repeat(np.arange(len(blocks)), counts)
        order = np.argsort(short, kind="stable")
        starts = runs(short[order])
        size = np.diff(np.append(starts, len(order)))
        several = np.maximum.reduceat(beside[order] >> np.uint64(7), starts) > 0
        often = np.add.reduceat(2.0 ** (beside[order] & np.uint64(127)).astype(float), starts) >= CROWDED
        shared, crowded = (np.empty(len(order), bool) for _ in range(2))
        shared[order], crowded[order] = np.repeat(several | (size > 1), size), np.repeat(often, size)
        found = np.flatnonzero(shared)
        first = runs(held[found])
        payloads = [packing.pack(short[found[lo:hi]], crowded[found[lo:hi]])[1][0].as_py()
                    for lo, hi in ranges(first, len(found))]
        rows = held[found][first]
        return pa.table({"block": pa.array(blocks[rows]), "bucket": pa.array(buckets[rows], pa.int32()),
                         "payload": pa.array(payloads, pa.binary())})
    return run


# ------------------------------------------------------------------ contexts
_COLUMNS = np.arange(AROUND)


def _contexts(codes: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Records of the bytes around anchors that the passages ``first`` to ``last`` cover, and those two places."""
    origin = at - (PLACES - 1)
    padded = np.concatenate([np.zeros(PLACES, np.uint8), codes, np.zeros(LENGTH, np.uint8)])
    out = np.zeros((len(at), CONTEXT_BYTES), np.uint8)
    place = (origin[:, None] + _COLUMNS)
    covered = (place >= first[:, None]) & (place < last[:, None] + LENGTH)
    out[:, :AROUND] = np.where(covered, padded[np.clip(place + PLACES, 0, len(padded) - 1)], 0)
    out[:, AROUND], out[:, AROUND + 1] = first - origin, last - origin
    return out


def _record_hashes(records: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(records).view("<u8")
    with np.errstate(over="ignore"):
        salt = mixed(np.arange(1, words.shape[1] + 1, dtype=np.uint64))
        return mixed(mixed(words + salt).sum(axis=1, dtype=np.uint64))


def _equal_records(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index of each different record, and for every record which of these it equals."""
    hashes = _record_hashes(records)
    order = np.argsort(hashes, kind="stable")
    starts = runs(hashes[order])
    group = np.empty(len(records), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    one = order[starts]
    if not np.array_equal(records, records[one][group]):  # two records with one hash
        _, one, group = np.unique(records, axis=0, return_index=True, return_inverse=True)
        group = group.reshape(-1)
    return one, group


def _least(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, group, values)
    return out


def _victims(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of passages by row, neighbouring ranges joined."""
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    apart = np.ones(len(row), bool)
    apart[1:] = (row[1:] != row[:-1]) | (first[1:] > last[:-1] + 1)
    starts = np.flatnonzero(apart)
    return row[starts], first[starts], np.maximum.reduceat(last, starts) if len(starts) else last


def _surroundings(packing: KeyPacking, bits: int):
    """The contexts of a block's shared anchors to their buckets, and what the block knows already to itself."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        short, crowded, _ = packing.unpack(answers.column("bucket").to_numpy(), answers.column("payload"))
        order = np.argsort(short)
        short, crowded = short[order], crowded[order] > 0
        _, texts_, ids = _block_rows(texts)
        contexts, keys, docs, members, gone, held = [], [], [], [], [], 0
        for data, owner, ends, offsets in _segments(texts_) if len(short) else ():
            at, first, last, hashes = anchors(data, ends)
            near = np.minimum(np.searchsorted(short, packing.short(hashes)), len(short) - 1)
            mine = np.flatnonzero(short[near] == packing.short(hashes))
            split = crowded[near[mine]]
            served = np.where(split, last[mine] - first[mine] + 1, 1)
            which = np.repeat(mine, served)
            step = np.arange(len(which)) - np.repeat(np.cumsum(served) - served, served)
            apart = np.repeat(split, served)
            low = first[which] + np.where(apart, step, 0)
            high = np.where(apart, low, last[which])
            for start in range(0, len(which), 1 << 15):
                w, f, t, own = (x[start:start + (1 << 15)] for x in (which, low, high, apart))
                records = _contexts(np.frombuffer(data, np.uint8), at[w], f, t)
                one, group = _equal_records(records)
                part = np.searchsorted(ends, at[w], "right") - 1
                row, shift = owner[part], offsets[part] - ends[part]
                least = _least(group, ids[row], len(one))
                over = ids[row] > least[group]
                gone.append(_victims(row[over], (f + shift)[over], (t + shift)[over]))
                contexts.append(records[one])
                keys.append(np.where(own[one], _record_hashes(records[one]), hashes[w[one]]))
                docs.append(least)
                members.append((held + group[~over], row[~over], (at[w] - (PLACES - 1) + shift)[~over]))
                held += len(one)
        if not contexts:
            return _passed([])
        records, key, doc = (np.concatenate(x) for x in (contexts, keys, docs))
        contexts.clear()
        ref, row, at = (np.concatenate([m[k] for m in members]) for k in range(3))
        one, group = _equal_records(records)
        least = _least(group, doc, len(one))
        over = (doc > least[group])[ref]  # contexts that a smaller id of the block holds too
        gone.append(_victims(row[over], at[over] + records[ref[over], AROUND], at[over] + records[ref[over], AROUND + 1]))
        bucket = (key[one] >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(one), np.int32)
        number[order] = np.arange(len(one))
        sent, block = records[one[order]], texts.column("_block")[0].as_py()
        out = [(int(bucket[order[lo]]), block, 0, lo, hi - lo, packed_columns(
            [sent[lo:hi, :AROUND], sent[lo:hi, AROUND], sent[lo:hi, AROUND + 1], least[order[lo:hi]]]))
            for lo, hi in ranges(runs(bucket[order]), len(order))]
        ref = number[group[ref[~over]]]
        by = np.argsort(ref, kind="stable")
        for kind, kinds, columns in ((1, VICTIM, [np.concatenate([g[k] for g in gone]) for k in range(3)]),
                                     (2, MEMBER, [ref[by], row[~over][by], at[~over][by]])):
            out.append((block % (1 << bits), block, kind, 0, len(columns[0]),
                        packed_columns([c.astype(t) for c, t in zip(columns, kinds, strict=True)])))
        return _passed(out)
    return run


def _passed(rows: list[tuple]) -> pa.Table:
    names = ["bucket", "block", "kind", "first", "n", "payload"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table({name: pa.array([r[k] for r in rows], t) for k, (name, t) in enumerate(zip(names, types, strict=True))})


# ------------------------------------------------------------------ deep-shallow sorting
class Text:
    """A text whose suffixes are compared by characters of 8 bytes, to a given depth in bytes."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.depth = depth
        self.codes = np.concatenate([codes, np.zeros(depth + 8, np.uint8)])
        n = len(codes) + depth
        self.words = np.zeros(n, np.uint64)
        for i in range(8):
            self.words |= self.codes[i:i + n].astype(np.uint64) << np.uint64(56 - 8 * i)

    def character(self, starts: np.ndarray, k: int) -> np.ndarray:
        word = self.words[starts + 8 * k]
        spare = 8 * (k + 1) - self.depth
        return word if spare <= 0 else word & ~np.uint64((1 << (8 * spare)) - 1)


def _multikey_quicksort(text: Text, starts: np.ndarray) -> np.ndarray:
    """The suffixes ordered by their first ``SHALLOW`` characters: ternary partitions, small parts sorted at once."""
    out, todo = [], [(starts, 0)]
    while todo:
        part, k = todo.pop()
        if k == SHALLOW or len(part) < 2:
            out.append(part)
        elif len(part) <= SMALL:
            out.append(part[np.lexsort([text.character(part, c) for c in range(SHALLOW - 1, k - 1, -1)])])
        else:
            key = text.character(part, k)
            pivot = np.sort(key[::max(1, len(key) // 9)])[4]
            todo += [(part[key > pivot], k), (part[key == pivot], k + 1), (part[key < pivot], k)]
    return np.concatenate(out) if out else starts


def _common(text: Text, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes share, ``depth`` if all."""
    shared = np.full(len(a), text.depth)
    for k in range(-(-text.depth // 8) - 1, -1, -1):
        differ = text.character(a, k) ^ text.character(b, k)
        there = np.flatnonzero(differ)
        d = differ[there]
        zero_bytes = sum((d < np.uint64(1 << (64 - 8 * i))).astype(np.int64) for i in range(1, 8))
        shared[there] = 8 * k + zero_bytes
    return shared


def _blind_tries(text: Text, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Order the groups that share their shallow characters, all groups a level at a time; returns where equals start.

    A group's first suffix is the spine of its trie. A node holds only how many bytes are shared and the byte that
    branches off; suffixes that branch below the spine's byte come before it, the earliest first, the others after it, the
    latest first. What branches off together is a smaller trie of the next level; what never does equals the spine.
    """
    starts = np.flatnonzero(new)
    group = np.repeat(starts, np.diff(np.append(starts, len(order))))
    size = np.repeat(np.diff(np.append(starts, len(order))), np.diff(np.append(starts, len(order))))
    open_ = np.flatnonzero(size > 1)
    while len(open_):
        spine, own = order[group[open_]], order[open_]
        shared = _common(text, own, spine)
        equal = shared == text.depth
        branch = text.codes[own + np.minimum(shared, text.depth - 1)].astype(np.int64)
        above = branch > text.codes[spine + np.minimum(shared, text.depth - 1)]
        node = np.where(equal, 1 << 16, (above.astype(np.int64) << 17) | (np.where(above, 255 - shared, shared) << 8) | branch)
        key = (group[open_] << 18) | node
        by = np.argsort(key, kind="stable")
        order[open_], key, equal = own[by], key[by], equal[by]
        first = runs(key)
        new[open_[first]] = True
        many = np.diff(np.append(first, len(key)))
        group[open_] = np.repeat(open_[first], many)
        open_ = open_[(np.repeat(many, many) > 1) & ~equal]
    return new


def suffix_order(text: Text, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts`` in order to the text's depth, and the positions where unequal ones begin."""
    order = _multikey_quicksort(text, starts)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in range(SHALLOW):
        key = text.character(order, k)
        new[1:] |= key[1:] != key[:-1]
    new = _blind_tries(text, order, new)
    return order, np.flatnonzero(new)


def _columns(table: pa.Table, kind: int, kinds: list) -> list[np.ndarray]:
    """The columns of all rows of one kind, one after the other."""
    rows = table.filter(pa.array(table.column("kind").to_numpy() == kind))
    parts = [unpacked_columns(p, n, kinds) for p, n in zip(rows.column("payload").to_pylist(),
                                                           rows.column("n").to_pylist(), strict=True)]
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else unpacked_columns(b"", 0, kinds)


def _compare(table: pa.Table) -> pa.Table:
    """A bucket's passages in order: those that a smaller id holds too, back to their blocks; what is known passes on."""
    kind = table.column("kind").to_numpy()
    known = table.filter(pa.array(kind > 0)).select(["block", "kind", "n", "payload"])
    mine = table.filter(pa.array(kind == 0))
    context, first, last, owner = _columns(table, 0, CONTEXT)
    served = last.astype(np.int64) - first + 1
    record = np.repeat(np.arange(len(context)), served)
    place = np.arange(len(record)) - np.repeat(np.cumsum(served) - served, served) + first[record]
    text = Text(context.reshape(-1), LENGTH)
    order, begins = suffix_order(text, record * AROUND + place)
    if not len(order):
        return known
    doc = owner[order // AROUND]
    least = np.minimum.reduceat(doc, begins)
    gone = order[doc > np.repeat(least, np.diff(np.append(begins, len(order))))]
    masks = np.zeros(len(context), np.uint64)
    np.bitwise_or.at(masks, gone // AROUND, np.uint64(1) << (gone % AROUND).astype(np.uint64))
    out = [known]
    counts = mine.column("n").to_numpy()
    ends = np.cumsum(counts)
    for block, start, lo, hi in zip(mine.column("block").to_pylist(), mine.column("first").to_pylist(),
                                    ends - counts, ends, strict=True):
        some = np.flatnonzero(masks[lo:hi])
        if len(some):
            payload = packed_columns([(start + some).astype("<i4"), masks[lo:hi][some]])
            out.append(pa.table({"block": pa.array([block]), "kind": pa.array([0], pa.int32()),
                                 "n": pa.array([len(some)], pa.int32()), "payload": pa.array([payload], pa.binary())}))
    return pa.concat_tables(out, promote_options="permissive")


# ------------------------------------------------------------------ texts without repeats
def _gone(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ranges of passages to remove of a block, from what it knew and from the masks of its contexts."""
    known = _columns(table, 1, VICTIM)
    marked, masks = _columns(table, 0, MASK)
    ref, row, at = _columns(table, 2, MEMBER)
    if len(marked):
        order = np.argsort(marked)
        marked, masks = marked[order], masks[order]
        near = np.minimum(np.searchsorted(marked, ref), len(marked) - 1)
        mine = marked[near] == ref
        bits = np.unpackbits(masks[near[mine]].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, place = np.nonzero(bits)
        start = at[mine][which] + place
        known = [np.concatenate(c) for c in zip(known, _victims(row[mine][which], start, start), strict=True)]
    return _victims(*(c.astype(np.int64) for c in known))


def _cut(texts: pa.Table, returned: pa.Table) -> pa.Table:
    """The rows of a block with their removed ranges and what is left."""
    table, data, _ = _block_rows(texts)
    spans: list[list[dict]] = [[] for _ in data]
    kept = list(data)
    rows, first, last = _gone(returned)
    for lo, hi in ranges(runs(rows), len(rows)):
        row = int(rows[lo])
        start, stop = first[lo:hi], last[lo:hi] + LENGTH
        reach = np.maximum.accumulate(stop)
        begins = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
        starts, stops = start[begins].tolist(), reach[np.append(begins[1:], len(start)) - 1].tolist()
        spans[row] = [{"start": s, "stop": t} for s, t in zip(starts, stops, strict=True)]
        kept[row] = b"".join(data[row][a:b] for a, b in zip([0, *stops], [*starts, len(data[row])], strict=True))
    return pa.table({"doc_id": table.column("doc_id"), "n_bytes": pa.array([len(d) for d in data], pa.int64()),
                     "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                     "kept": pa.array(kept, pa.binary())})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (maximal removed ranges of bytes) and ``kept``, the bytes left.

    A byte goes if it lies in a passage of 50 bytes that a document with a smaller id holds as well. Passages are judged
    on the input. Ids are integers; null is the smallest, and rows that repeat an id do not take from each other. Null
    texts are empty; texts below 50 bytes stay as they are; texts of any length are cut into overlapping segments. An empty
    table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    total = input_bytes(docs, text)
    bits = bucket_bits(total)
    packing = KeyPacking(bits, 40, 8)
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = blocked(docs, [F.col(id_col).alias("doc_id"), order.alias("_order"), text.alias("text")], total)
    announced = rows.groupBy("_block").applyInArrow(_announce(packing), "bucket int, block long, payload binary")
    answers = announced.groupBy("bucket").applyInArrow(_answer(packing), "block long, bucket int, payload binary")
    contexts = rows.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(_surroundings(packing, bits), PASSED)
    returned = contexts.groupBy("bucket").applyInArrow(_compare, RETURNED)
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.groupBy("_block").cogroup(returned.groupBy("block")).applyInArrow(
        _cut, f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
