"""Operator 2, word-piece counts by a linear longest-match automaton.

Greedy longest match cuts a word into the longest piece that starts it, then the longest continuing piece, and so on.
The automaton is a trie of the vocabulary whose nodes have a failure link and the number of pieces that following the
link pops. A word is read once, left to right: where a character has no edge, the popped count is added and the link
followed. No piece is ever built or looked up, and the work is linear in the word's length, however long it is.

Counts of distinct words are kept in a bounded table inside each task, since most words repeat.
"""

from __future__ import annotations

import functools
import re
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import over_batches

#: A word is a run of letters, digits and underscores, or one other visible character.
WORD = re.compile(r"\w+|[^\w\s]")
_SPACE = re.compile(r"\s")
WORD_START = "▁"
CACHED_WORDS, CACHED_CHARS = 400_000, 64
_PIECE = 1 << 20
_UNKNOWN = 1 << 40  # an unknown word counts as one piece, and once here


class Automaton:
    """Piece counts of words over ``initial`` pieces (at a word's start) and ``continuing`` ones (anywhere after)."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]  # 0 the start of a word, 1 after a piece
        whole = set()
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                at = root
                for c in piece:
                    if c not in self.edges[at]:
                        self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                    at = self.edges[at][c]
                if piece:
                    whole.add(at)
        self.link = [-1] * len(self.edges)
        self.popped = [0] * len(self.edges)
        waiting = deque([0, 1])
        while waiting:  # nearer nodes first: a link always leads to a node that is done
            at = waiting.popleft()
            for c, below in self.edges[at].items():
                waiting.append(below)
                if below in whole:
                    self.link[below], self.popped[below] = 1, 1
                    continue
                popped, to = self.popped[at], self.link[at]
                while to >= 0 and c not in self.edges[to]:
                    popped, to = popped + self.popped[to], self.link[to]
                if to >= 0:
                    self.link[below], self.popped[below] = self.edges[to][c], popped

    def pieces(self, word: str) -> int:
        """How many pieces the word is cut into; 0 if it cannot be cut."""
        edges, link, popped = self.edges, self.link, self.popped
        at, n = 0, 0
        for c in word:
            while c not in edges[at]:
                if link[at] < 0:
                    return 0
                n, at = n + popped[at], link[at]
            at = edges[at][c]
        while at != 1:
            if link[at] < 0:
                return 0
            n, at = n + popped[at], link[at]
        return n


class _Counts(dict):
    """Pieces of each word seen, filled on demand and emptied when full."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.pieces(word) or 1 + _UNKNOWN
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Initial and continuing pieces of a sentencepiece file: those with the word-start sign, and the others."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return ([p[1:] for p in pieces if p.startswith(WORD_START)], [p for p in pieces if WORD_START not in p])


@functools.lru_cache(maxsize=2)
def _counts(path: str) -> _Counts:
    return _Counts(Automaton(*sentencepiece_vocabulary(path)))


def _pieces_of(text: str) -> Iterator[str]:
    """The text cut after white space into parts of about a million characters."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, min(at + _PIECE, len(text)))
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_tokens, n_unknown``.

    A word that cannot be cut counts as one token. Null and empty texts count zero. Repeated rows give repeated
    results, an empty table none; other columns are not read. ``path`` must exist on every executor.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counts(path)
        words, totals = [], []
        for text in batch.column("_text").to_pylist():
            n = total = 0
            for part in _pieces_of(text or ""):
                found = WORD.findall(part)
                n += len(found)
                total += sum(map(counts.__getitem__, found))
            words.append(n)
            totals.append(total)
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(words, pa.int64()), pa.array([t % _UNKNOWN for t in totals], pa.int64()),
             pa.array([t // _UNKNOWN for t in totals], pa.int64())], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    id_type = base.schema["_id"].dataType.simpleString()
    return base.mapInArrow(over_batches(run), f"doc_id {id_type}, n_words long, n_tokens long, n_unknown long")
