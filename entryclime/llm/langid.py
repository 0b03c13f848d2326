"""Operator 10, language identification by nearest centroid.

A text becomes a TF-IDF vector of its letter bigrams and trigrams (lower case, word ends included), hashed to ``DIM``
buckets and scaled to length one. Each language is a few centroids, found by spherical k-means; a text gets the language
of the centroid with the largest cosine, and is rejected where that cosine is far below what training texts of like
length reach.

Three passes over the corpus: document frequencies over all training texts, clustering of a sample of about
``FIT_ROWS`` different training texts per language (inside tasks, one language each), and prediction of every text. Sums
leave a task as one row per bucket. The driver holds one row per bucket, per centroid and per length class only.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import drop_rows, fold, row_key
from entryclime.session import write_stage

DIM = 4096
CENTROIDS = 3
#: Different training texts per language that clustering sees, at most about (a hash of the text picks them); all, if
#: a language has no more.
FIT_ROWS = 600
ROUNDS = 12
#: A text is rejected below this share of the cosine that 99 % of the training texts of about its length exceed.
REJECT_SHARE = 0.5
#: Different training texts that a floor needs; a length class with fewer takes in its neighbours.
FLOOR_TEXTS = 50
#: Texts of fewer letters than 2 to this power are one length class.
LEAST_CLASS = 6
MOST_CLASS = 31
UNKNOWN = "und"
#: Signs that are turned into grams at once, and texts: what a task holds besides its batch.
_PIECE = 1 << 16
_ROWS = 128
_PICKS = 1 << 40


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code points to themselves where they are letters, else to 0."""
    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), np.uint32, 0x110000)


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Gram counts by bucket, a row per text, and letters per text."""
    counts = np.zeros((len(texts), DIM), np.float32)
    letters = np.zeros(len(texts), np.int64)
    lowered = [t.lower() for t in texts]
    pieces = [(i, at) for i, t in enumerate(lowered) for at in range(0, len(t), _PIECE)]
    start = 0
    while start < len(pieces):
        end, size, parts = start, 0, []
        while end < len(pieces) and size < _PIECE:
            i, at = pieces[end]
            t, stop = lowered[i], at + _PIECE
            # the signs before and after a piece are context only, so that texts count alike wherever they are cut
            parts.append((t[at - 1] if at else "\n") + t[at:stop] + (t[stop] if stop < len(t) else "\n"))
            size += len(parts[-1])
            end += 1
        sizes = np.array([len(p) for p in parts])
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), "<u4")
        s, owner, own_sign = _letters()[codes], np.repeat([i for i, _ in pieces[start:end]], sizes), np.ones(size, bool)
        own_sign[np.cumsum(sizes) - 1] = own_sign[np.cumsum(sizes) - sizes] = False
        kept = np.flatnonzero((s != 0) | (np.concatenate([[1], s[:-1]]) != 0))  # runs of other signs become one gap
        s, owner, own_sign = s[kept].astype(np.uint64), owner[kept], own_sign[kept]
        mid = np.flatnonzero((s != 0) & own_sign)
        first, last = pieces[start][0], pieces[end - 1][0] + 1
        a, b, c, own = s[mid - 1], s[mid], s[mid + 1], (owner[mid].astype(np.int64) - first) * DIM
        two = (b * np.uint64(0x9E3779B97F4A7C15) + c * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
        three = (two + a * np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB)
        shift = np.uint64(64 - DIM.bit_length() + 1)
        for h in (two, three):
            found = np.bincount(own + (h >> shift).astype(np.int64), minlength=(last - first) * DIM)
            counts[first:last] += found.reshape(-1, DIM)
        letters += np.bincount(owner[mid], minlength=len(texts))
        start = end
    return counts, letters


def vectors_of(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors (zero for a text without a letter) and letters per text."""
    counts, letters = _counts(texts)
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1), letters


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for at in range(0, batch.num_rows, _ROWS):
        part = batch.slice(at, _ROWS)
        yield part, [t or "" for t in part.column(column).to_pylist()]


@dataclass(frozen=True)
class Model:
    """Inverse document frequencies and unit centroids with their languages."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: tuple[str, ...]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine of the nearest centroid (0 to 1) and letters of each text."""
        v, letters = vectors_of(texts, self.idf)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), letters
        cosine = np.clip(v @ self.centroids.T, 0, 1).astype(np.float64)
        best = cosine.argmax(axis=1)
        score = np.where(letters > 0, cosine[np.arange(len(texts)), best], 0.0)
        return [self.langs[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)], score, letters


def _cluster(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: seeds are the rows farthest from those before, empty clusters are dropped."""
    centers = v.mean(axis=0, keepdims=True)
    centers = v[[int((v @ centers[0]).argmax())]]
    while len(centers) < min(k, len(v)):
        centers = np.vstack([centers, v[int((v @ centers.T).max(axis=1).argmin())]])
    for _ in range(ROUNDS):
        own = (v @ centers.T).argmax(axis=1)
        sums = np.vstack([v[own == j].sum(axis=0) for j in range(len(centers)) if (own == j).any()])
        fresh = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if fresh.shape == centers.shape and np.allclose(fresh, centers, atol=1e-6):
            break
        centers = fresh
    return centers


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS,
        centroids: int = CENTROIDS) -> Model:
    """Learn from every row of ``train`` with a language; texts that are null or hold no letter teach nothing.

    Copies of a text count in the document frequencies, but as one text of their language in the clustering.
    """
    rows = train.select(F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang")).where(
        "_text IS NOT NULL AND _lang IS NOT NULL").withColumn("_key", F.xxhash64("_text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for part, texts in _texts(batch, "_text"):
                counts, letters = _counts(texts)
                seen += (counts > 0).sum(axis=0)
                total += len(texts)
                some = pa.array(np.flatnonzero(letters))
                none = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_lang").take(some), part.column("_key").take(some), none, none], names)
        none = pa.nulls(DIM + 1, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.nulls(DIM + 1, pa.string()), none, pa.array(np.arange(DIM + 1)),
                                          pa.array(np.append(seen, total))], names)

    names = ["_lang", "_key", "bucket", "n"]  # a row per text with a letter, and one per bucket
    counted = write_stage(rows.mapInArrow(frequencies, "_lang string, _key long, bucket long, n long"), "langid_counts")
    found = {r["bucket"]: r["n"] for r in counted.where("bucket IS NOT NULL")
             .groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = found.get(DIM, 0)
    idf = np.array([np.log((1 + total) / (1 + found.get(b, 0))) + 1 for b in range(DIM)], np.float32)

    share = (counted.where("bucket IS NULL").select("_lang", "_key").distinct()
             .groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
             .select(F.col("_lang").alias("_l"), (F.lit(float(fit_rows)) / F.col("_n")).alias("_share")))
    picked = (rows.join(F.broadcast(share), F.col("_lang") == F.col("_l"))  # a row per language
              .where(F.pmod("_key", F.lit(_PICKS)) < F.col("_share") * _PICKS)
              .groupBy("_lang", "_key").agg(F.first("_text").alias("_text")))  # copies fold before the exchange

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch, "_text"):
                v, letters = vectors_of(texts, idf)
                some = np.flatnonzero(letters)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_lang").take(pa.array(some)), pa.array([v[i].tobytes() for i in some], pa.binary())],
                    ["_lang", "_v"])

    def clustered(group: pa.Table) -> pa.Table:
        raw = sorted(group.column("_v").to_pylist())
        centers = _cluster(np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), DIM), centroids)
        return pa.table({"lang": [group.column("_lang")[0].as_py()] * len(centers),
                         "centroid": pa.array([c.astype(np.float32).tobytes() for c in centers], pa.binary())})

    learned = sorted((r["lang"], bytes(r["centroid"])) for r in
                     picked.mapInArrow(vectors, "_lang string, _v binary").groupBy("_lang")
                     .applyInArrow(clustered, "lang string, centroid binary").collect())
    return Model(idf, np.array([np.frombuffer(c, np.float32) for _, c in learned], np.float32).reshape(-1, DIM),
                 tuple(lang for lang, _ in learned))


def _windows(texts: dict[int, int], least: int = FLOOR_TEXTS) -> dict[int, tuple[int, int]]:
    """For every length class the first and last class of the least window around it with ``least`` texts, or with all."""
    found, total = {}, sum(texts.values())
    for own in range(LEAST_CLASS, MOST_CLASS + 1):
        reach = 0
        while sum(n for c, n in texts.items() if abs(c - own) <= reach) < min(least, total):
            reach += 1
        found[own] = max(LEAST_CLASS, own - reach), min(MOST_CLASS, own + reach)
    return found


def identify(docs: DataFrame, model: Model, learned_from: str = "true", id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score, letters, rejected``, ``_h`` and the flag ``_learned``.

    ``score`` is the cosine of the nearest centroid. A null text or one without a letter is ``und`` with score 0 and is
    rejected; so is a text whose score is below ``REJECT_SHARE`` of the first percentile of the different training texts
    (of the rows of the SQL condition ``learned_from``) of its length class, the binary logarithm of its letters (short
    texts form one class). A class with fewer than ``FLOOR_TEXTS`` such texts, or none, takes in its neighbours until
    there are enough, and the smallest score of so many texts never sets the floor; with fewer texts in all, it does.
    Repeated rows give repeated results, an empty table none, and without any training row every document is ``und``.
    """
    base = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("_text"),
                       F.expr(learned_from).alias("_learned"))
    id_type = base.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _texts(batch, "_text"):
                langs, score, letters = model.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_h"), part.column("_learned"), pa.array(langs, pa.string()),
                     pa.array(score), pa.array(letters)], ["_id", "_h", "_learned", "lang_pred", "score", "letters"])

    rows = write_stage(base.mapInArrow(
        run, f"_id {id_type}, _h long, _learned boolean, lang_pred string, score double, letters long"), "langid_rows")
    length = F.greatest(F.lit(LEAST_CLASS), F.floor(F.log2(F.col("letters").cast("double"))).cast("int"))
    learned = write_stage(rows.where("_learned AND letters > 0").groupBy("_h", length.alias("_length"))
                          .agg(F.min("score").alias("score")), "langid_learned")
    classes = learned.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 64 rows
    texts = {r["_length"]: r["n"] for r in classes}
    windows = _windows(texts)

    def floor_of(low: int, high: int) -> Column:
        n = sum(texts.get(c, 0) for c in range(low, high + 1))
        rank = max(0.01, 1.5 / n) if n >= FLOOR_TEXTS else 0.01  # of enough texts, the second smallest at least
        return F.percentile_approx(F.when(F.col("_length").between(low, high), F.col("score")), rank, 10_000)

    own = sorted(set(windows.values()))
    found = dict(zip(own, learned.agg(*[floor_of(*w) for w in own]).first(), strict=True))  # one row
    floors = F.array(*[F.lit(found[windows[c]]).cast("double") for c in sorted(windows)])
    return (rows.withColumn("_floor", F.get(floors, length - LEAST_CLASS) * REJECT_SHARE)
            .select(F.col("_id").alias("doc_id"), "lang_pred", "score", "letters",
                    (F.col("lang_pred").eqNullSafe(UNKNOWN) | F.coalesce(F.col("score") < F.col("_floor"), F.lit(False)))
                    .alias("rejected"), "_h", "_learned"))


FOLDS, HELD_OUT = 4, 2


def identify_by_folds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
                      ) -> DataFrame:
    """``identify`` with a model of the rows whose id is not in the held-out fold; adds ``held_out``.

    A null id belongs to the held-out rows. Language, source and id are no inputs of a prediction.
    """
    held_out = F.coalesce(fold(id_col, FOLDS) == HELD_OUT, F.lit(True))
    marked = docs.select(F.col(id_col), F.col(text_col), F.col(lang_col), held_out.alias("_held_out"))
    model = fit(marked.where(~F.col("_held_out")), text_col, lang_col)
    found = identify(marked, model, f"NOT _held_out AND `{lang_col}` IS NOT NULL", id_col, text_col)
    return found.withColumn("held_out", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(True)))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
                    ) -> DataFrame:
    """``docs`` without the rows that language identification rejects; columns unchanged."""
    found = identify_by_folds(docs, id_col, text_col, lang_col).where("rejected")
    return drop_rows(docs, found.withColumnRenamed("doc_id", "_id"), id_col, text_col)
