"""Operator 9, byte-level BPE encoding and decoding, long texts by tree concatenation.

A text of up to ``leaf_chars`` characters is encoded whole, inside the task that scans it. A longer text is halved
until every leaf is short enough; leaves of one text are encoded by different tasks, and then joined in pairs, level by
level, until one sequence is left. A join re-encodes a window around the cut, and widens it until both sides agree.

Why a join is exact. The tokenizer cuts a text into runs (letters, digits, other signs, white space) and merges bytes
inside a run only. A window edge is sound in two cases:

* it is a definite boundary: the two characters around it are of kinds that never share a run, whatever comes
  before or after (and no special token spans them); or
* it lies inside one run that reaches the cut, and the window's outermost token is the very token that the side has
  there. A sequence of tokens is the BPE encoding of a run exactly when each pair of neighbours is, so agreement on
  that token carries over to everything beyond it.

A window that reaches both ends is a plain encoding, so the search always ends.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import over_batches, text_or_empty

LEAF_CHARS = 16_384
FIRST_WINDOW = 16  # tokens on each side of a cut

#: Fixed value: the run pattern of byte-level BPE tokenizer files with ``use_regex``.
RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Kinds of neighbouring characters that never share a run: L letter, N digit, O other sign, S white space.
SPLIT_KINDS = {"LN", "LO", "NL", "NO", "ON", "LS", "NS", "OS"}


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable bytes themselves, others from 256 up."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """A byte-level BPE tokenizer file, with the window joins of this module."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(c.isspace() for t in self.special for c in t):
            raise ValueError(f"{path}: special tokens with white space are not supported")
        byte_of = _byte_of_char()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][a + b] for a, b in pairs]
        if order != sorted(order):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self.core = tiktoken.Encoding("file", pat_str=RUNS, mergeable_ranks=ranks, special_tokens=self.special)
        self.bytes_of = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self.margin = max([16, *(len(t) + 3 for t in self.special)])
        self._runs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self._kinds: dict[str, str] = {}

    def encode(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    def decode(self, ids: np.ndarray) -> str:
        return self.core.decode_bytes(ids.tolist()).decode("utf-8", "replace")

    def kind(self, char: str) -> str:
        if char not in self._kinds:
            probes = {"L": "a", "N": "1", "O": "!"}
            self._kinds[char] = next((k for k, p in probes.items() if len(self._runs.pre_tokenize_str(p + char)) == 1), "S")
        return self._kinds[char]

    def _edges(self, ids: np.ndarray) -> tuple[str, list[tuple[int, int]]]:
        """The text of whole characters in ``ids`` and (character offset, tokens before it) of its token boundaries."""
        data, at, marks = bytearray(), 0, []
        for i, t in enumerate(ids.tolist()):
            marks.append((len(data), i))
            data += self.bytes_of[t]
        marks.append((len(data), len(ids)))
        first = next((i for i, b in enumerate(data) if b & 0xC0 != 0x80), len(data))  # a character may have begun before
        text = bytes(data[first:]).decode("utf-8", "ignore")
        edges, chars, done = [], 0, first
        for at, n in marks:
            if at < first or (at < len(data) and data[at] & 0xC0 == 0x80):
                continue
            piece = bytes(data[done:at]).decode("utf-8", "ignore")
            chars, done = chars + len(piece), at
            edges.append((chars, n))
        return text, edges

    def _definite(self, text: str, i: int) -> bool:
        if self.kind(text[i - 1]) + self.kind(text[i]) not in SPLIT_KINDS:
            return False
        return not any(text.find(t, max(0, i - len(t) + 1), i + len(t) - 1) >= 0 for t in self.special)

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The encoding of two neighbouring texts together, from their own encodings."""
        if not len(left) or not len(right):
            return left if len(left) else right
        k = FIRST_WINDOW
        while True:
            all_left, all_right = k >= len(left), k >= len(right)
            tail, head = left[-k:], right[:k]
            before, starts = self._edges(tail)
            after, ends = self._edges(head)
            text, cut, whole = before + after, len(before), all_left and all_right
            if whole:
                return self.encode(text)
            start = self._outer(text, cut, starts, all_left, -1)
            end = self._outer(text, cut, [(cut + c, n) for c, n in ends], all_right, 1)
            if start and end:
                (s, ls, left_sure), (e, re, right_sure) = start, end
                window = self.encode(text[s:e])
                if (left_sure or window[0] == tail[ls]) and (right_sure or window[-1] == head[re - 1]):
                    return np.concatenate([left[:len(left) - len(tail) + ls], window, right[re:]])
            k *= 2

    def _outer(self, text: str, cut: int, edges: list[tuple[int, int]], whole: bool, side: int
               ) -> tuple[int, int, bool] | None:
        """A sound window edge on one side of ``cut``: (offset, token, whether definite)."""
        if whole:
            return (*(edges[0] if side < 0 else edges[-1]), True)
        usable = [(c, n) for c, n in edges if self.margin <= (cut - c) * -side and self.margin <= c <= len(text) - self.margin]
        for c, n in sorted(usable, reverse=side < 0):  # the nearest first
            if self._definite(text, c):
                return c, n, True
        for c, n in sorted(usable, reverse=side < 0)[-1:]:  # the farthest, inside one run
            low, high = (c - 1, cut + 1) if side < 0 else (cut - 1, c + 1)
            if len({self.kind(x) for x in set(text[low:high])}) == 1:
                return c, n, False
        return None

    def join_all(self, leaves: list[np.ndarray]) -> np.ndarray:
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i:i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def halves(text: str, leaf_chars: int) -> list[str]:
    """The text halved until every part has at most ``leaf_chars`` characters."""
    parts = 1
    while len(text) > leaf_chars * parts:
        parts *= 2
    cuts = [len(text) * i // parts for i in range(parts + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


CODED = "_row long, doc_id {id}, n_tokens long, ids binary, decoded string"


def _coded(bpe: ByteBpe, rows: list, ids: list, codes: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(rows, pa.int64()), pa.array(ids, id_type), pa.array([len(c) for c in codes], pa.int64()),
        pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([bpe.decode(c) for c in codes], pa.string()),
    ], ["_row", "doc_id", "n_tokens", "ids", "decoded"])


#: Characters that one output batch is made of at most (a longer text is a batch by itself).
BATCH_CHARS = 4_000_000


def _spans(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BATCH_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if texts:
        yield slice(start, len(texts))


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids, decoded``.

    ``ids`` holds little-endian unsigned 32-bit integers, as the tokenizer file gives them without added special
    tokens; special strings inside a text become their ids, as in the tokenizers library. ``decoded`` is made from
    ``ids``. A null text counts as empty and has no tokens. Repeated rows give repeated results, an empty table none;
    other columns are not read. ``path`` must exist on every executor. A task holds one long text's ids at a time.
    """
    base = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
                       text_or_empty(text_col).alias("_text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    coded = CODED.format(id=id_type)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for span in _spans(texts):
                part = batch.slice(span.start, span.stop - span.start)
                yield _coded(bpe, part.column(0).to_pylist(), part.column(1).to_pylist(),
                             [bpe.encode(t) for t in texts[span]], batch.schema.field(1).type)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                leaves = halves(text.as_py(), leaf_chars)
                n = len(leaves)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row.as_py()] * n, pa.int64()), pa.array([doc_id.as_py()] * n, doc_id.type),
                    pa.array(range(n), pa.int32()), pa.array(leaves, pa.string())], ["_row", "doc_id", "_leaf", "_text"])

    def encode_leaves(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = tokenizer(path)
        codes = pa.array([bpe.encode(t).tobytes() for t in batch.column("_text").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns[:3], codes], ["_row", "doc_id", "_leaf", "_ids"])

    def join_text(leaves: pa.Table) -> pa.Table:
        bpe = tokenizer(path)
        leaves = leaves.sort_by("_leaf")
        codes = [np.frombuffer(b.as_buffer(), "<u4") for b in leaves.column("_ids")]
        whole = _coded(bpe, [leaves.column("_row")[0].as_py()], [leaves.column("doc_id")[0].as_py()],
                       [bpe.join_all(codes)], leaves.schema.field("doc_id").type)
        return pa.Table.from_batches([whole])

    is_long = F.length("_text") > leaf_chars
    at_once = base.where(~is_long).mapInArrow(short, coded)
    leaves = (base.where(is_long).mapInArrow(split, f"_row long, doc_id {id_type}, _leaf int, _text string")
              .repartition("_row", "_leaf")
              .mapInArrow(over_batches(encode_leaves), f"_row long, doc_id {id_type}, _leaf int, _ids binary"))
    joined = leaves.groupBy("_row").applyInArrow(join_text, coded)
    return at_once.unionByName(joined).drop("_row")


def digests(coded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of an ``encode_decode`` result."""
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
