"""Operator 1, quality scores by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled good in the training folds; everything in those folds is the unlabelled
web text. With class prior p, logistic loss l and score z, the risk to minimise is

    p * E_pos[l(z)] + max(0, E_unl[l(-z)] - p * E_pos[l(-z)])

and a step that would make the second part negative (a sign of overfitting the positives) is shortened until it does
not; where no length helps, a correcting step raises that part first. Labels of bad documents are never used; the prior is estimated from positives and unlabelled text alone, as the
smallest ratio of their shares above a threshold of a positive-against-unlabelled score.

Texts are reduced to ``len(FEATURES)`` numbers in the scan. Newton steps run on all training rows: a pass sums
gradients and curvature inside tasks and sends one row per matrix entry, so neither the model nor the driver sees rows.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.llm.common import fold
from entryclime.session import write_stage

FEATURES = ("word_length", "repeated_next", "distinct", "lower", "upper", "digit", "gaps",
            "stops", "shouts", "bars", "signs", "wordless", "caps_words", "sign_ends")
RIDGE = 1e-3
STEPS = 12
HALVINGS = 6
BINS = 1000
_PIECE = 1 << 20
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _SHOUT, _BAR, _SIGN = range(9)


@functools.lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point; letters without case count as lower case."""
    def of(c: int) -> int:
        s = chr(c)
        if s.isalpha():
            return _UPPER if s.isupper() else _LOWER
        if s.isdigit():
            return _DIGIT
        if s in "\n\r":
            return _LINE
        if s.isspace():
            return _SPACE
        return _STOP if s in ".,;:?'\"()-" else _SHOUT if s == "!" else _BAR if s == "|" else _SIGN
    return np.array([of(c) for c in range(0x110000)], np.uint8)


def features_of(texts: list[str]) -> np.ndarray:
    """A row of ``FEATURES`` per text; an empty text has zeros. Whole texts are read, in pieces of bounded size."""
    n = len(texts)
    chars = np.zeros((n, 9))
    words, next_same, distinct = np.zeros(n), np.zeros(n), np.zeros(n)
    word_sums = np.zeros((n, 3))
    for i, t in enumerate(texts):
        w = t.split()
        words[i], distinct[i] = len(w), len(set(w))
        next_same[i] = sum(map(operator.eq, w, w[1:]))
    pieces = [(i, t[at:at + _PIECE]) for i, t in enumerate(texts) for at in range(0, len(t), _PIECE)]
    start = 0
    while start < len(pieces):
        end, size = start, 0
        while end < len(pieces) and (end == start or size + len(pieces[end][1]) <= 2 * _PIECE):
            size += len(pieces[end][1])
            end += 1
        part = pieces[start:end]
        owner = np.repeat([i for i, _ in part], [len(t) + 1 for _, t in part])
        codes = np.frombuffer(("\n".join(t for _, t in part) + "\n").encode("utf-32-le", "replace"), "<u4")
        kind = _classes()[codes]
        chars += np.bincount(owner * 9 + kind, minlength=n * 9).reshape(n, 9)
        chars[:, _LINE] -= np.bincount([i for i, _ in part], minlength=n)  # the line ends put between pieces
        gap = (kind == _SPACE) | (kind == _LINE)
        begins = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        ends = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]])) - 1
        if len(begins):
            upto = [np.concatenate([[0], np.cumsum(m)]) for m in (kind <= _UPPER, kind == _LOWER)]
            letters, lowers = (u[ends + 1] - u[begins] for u in upto)
            flags = ((letters == 0), (letters > 1) & (lowers == 0), kind[ends] == _SIGN)
            for k, flag in enumerate(flags):
                word_sums[:, k] += np.bincount(owner[begins], weights=flag, minlength=n)
        start = end
    total = np.maximum(chars.sum(axis=1), 1)
    per_word = np.maximum(words, 1)
    chars[:, _SPACE] += chars[:, _LINE]
    chars = np.delete(chars, _LINE, axis=1)  # line ends say more about a text's length than about its quality
    visible = chars.sum(axis=1) - chars[:, _SPACE]
    return np.column_stack([
        np.log1p(visible / per_word), next_same / per_word,
        np.log1p(distinct) / np.log1p(per_word), chars / total[:, None], word_sums / per_word[:, None],
    ]).astype(np.float32)


# ------------------------------------------------------------------ distributed sums
def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and the flag of trusted positives, batch by batch."""
    for batch in batches:
        if batch.num_rows:
            raw = b"".join(batch.column("x").to_pylist())
            yield (np.frombuffer(raw, np.float32).reshape(-1, len(FEATURES)).astype(np.float64),
                   batch.column("positive").to_numpy(zero_copy_only=False).astype(bool))


def _totals(train: DataFrame, of_batch: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of a vector that ``of_batch`` makes from features and positive flags."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x, positive in _rows(batches):
            part = of_batch(x, positive)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    found = train.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(found, key=lambda r: r["k"])])


def _design(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    s = np.clip((x - mean) / std, -8, 8)
    return np.column_stack([np.ones(len(s)), s, np.minimum(s * s, 16) - 1])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class PuModel:
    """A logistic model of standardised features and their squares."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.std, self.weights, self.prior = mean, std, weights, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(_design(x, self.mean, self.std) @ self.weights)


def _parts(mean: np.ndarray, std: np.ndarray, w: np.ndarray):
    """Per batch: counts, losses, gradients and curvature of positives and of all rows."""
    def of_batch(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        d = _design(x, mean, std)
        z = d @ w
        s, up = _sigmoid(z), np.logaddexp(0, z)
        p = d[positive]
        curve = s * (1 - s)
        return np.concatenate([
            [len(d), len(p), up.sum(), up[positive].sum(), (up - z)[positive].sum()],
            d.T @ s, p.sum(axis=0), p.T @ s[positive], ((d * curve[:, None]).T @ d).ravel(),
            ((p * curve[positive, None]).T @ p).ravel()])
    return of_batch


def _unpack(t: np.ndarray, k: int) -> dict[str, np.ndarray]:
    n, m = t[0], max(t[1], 1)
    at = np.cumsum([5, k, k, k, k * k, k * k])
    return {"unl_neg": t[2] / n, "pos_neg": t[3] / m, "pos_pos": t[4] / m, "unl_grad": t[at[0]:at[1]] / n,
            "pos_mean": t[at[1]:at[2]] / m, "pos_grad": t[at[2]:at[3]] / m,
            "unl_curve": t[at[3]:at[4]].reshape(k, k) / n, "pos_curve": t[at[4]:at[5]].reshape(k, k) / m}


def class_prior(train: DataFrame, mean: np.ndarray, std: np.ndarray, w: np.ndarray, n: float, m: float) -> float:
    """The share of positives in unlabelled text: the best bin of a positive-against-unlabelled score."""
    def of_batch(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        at = np.minimum((_sigmoid(_design(x, mean, std) @ w) * BINS).astype(int), BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[positive], minlength=BINS)]).astype(float)

    counts = _totals(train, of_batch)
    above_unl, above_pos = (np.cumsum(c[::-1])[::-1] for c in (counts[:BINS], counts[BINS:]))
    q_unl, q_pos = above_unl / n, above_pos / m
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(m))
    usable = q_pos > slack
    if not usable.any():
        return 0.5
    bound = np.where(usable, (q_unl + slack) / np.where(usable, q_pos, 1), np.inf)
    best = int(bound.argmin())
    return float(np.clip(q_unl[best] / q_pos[best], 0.01, 0.99))


def minimise(at: Callable[[np.ndarray], dict], prior: float, ridge: np.ndarray) -> np.ndarray:
    """The weights of least non-negative risk that Newton steps find; ``at`` gives the sums of all rows for weights.

    A step goes along the unbiased risk, shortened until the negative part stays sound (not below 0) and the risk falls.
    Where no length does, the negative part holds the search back: the next step lowers the positives' part alone, along
    the weights that leave the negative part as it is. Where that fails too, a correcting step raises the negative part
    along its own gradient, and the search goes on from there. The best sound weights seen are returned.
    """
    def risk(s: dict, w: np.ndarray) -> tuple[float, float]:
        negative = s["unl_neg"] - prior * s["pos_neg"]
        return float(prior * s["pos_pos"] + max(0.0, negative) + w @ ridge @ w / 2), float(negative)

    w = np.zeros(len(ridge))
    s = at(w)
    now, negative = risk(s, w)
    best, best_w = now, w
    corrected = False
    for _ in range(STEPS):
        curve = s["unl_curve"] + ridge
        downhill = np.linalg.solve(curve, s["unl_grad"] - prior * s["pos_mean"] + ridge @ w)
        slope = s["unl_grad"] - prior * s["pos_grad"]  # of the negative part
        raising = -np.linalg.solve(curve, slope)
        positives = np.linalg.solve(curve, prior * (s["pos_grad"] - s["pos_mean"]) + ridge @ w)
        along = positives - (slope @ positives) / min(slope @ raising, -1e-12) * raising
        moved = False
        for step, correction in ((downhill, False), (along, False), (raising, True)):
            if correction and corrected:
                break  # two corrections on end: no step from here is sound
            for halving in range(HALVINGS):
                tried = w - step / 2 ** halving
                t = at(tried)
                then, negative_then = risk(t, tried)
                if negative_then > negative if correction else negative_then >= 0 and then < now:
                    moved = True
                    break
            if moved:
                break
        if not moved:
            break
        gain, w, s, now, negative, corrected = now - then, tried, t, then, negative_then, correction
        if negative >= 0 and now < best:
            best, best_w = now, w
        if not correction and gain < 1e-6:
            break
    return best_w


def fit(train: DataFrame) -> PuModel:
    """Minimise the non-negative risk over rows ``x`` (features) and ``positive``.

    Without any row or without a trusted positive the weights stay zero and every score is 0.5.
    """
    k = 2 * len(FEATURES) + 1
    sums = _totals(train, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(sums) or not sums[1]:
        return PuModel(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), np.zeros(k), 0.5)
    n, m = sums[:2]
    mean, square = sums[2:2 + len(FEATURES)] / n, sums[2 + len(FEATURES):] / n
    std = np.maximum(np.sqrt(np.maximum(square - mean * mean, 0)), 1e-4)

    ridge = RIDGE * np.eye(k)
    ridge[0, 0] = 1e-6

    def at(w: np.ndarray) -> dict[str, np.ndarray]:
        return _unpack(_totals(train, _parts(mean, std, w)), k)

    w = np.zeros(k)
    for _ in range(STEPS // 2):  # positives against unlabelled text, for the prior
        s = at(w)
        step = np.linalg.solve(s["unl_curve"] + s["pos_curve"] + ridge,
                               s["unl_grad"] + s["pos_grad"] - s["pos_mean"] + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-3:
            break
    prior = class_prior(train, mean, std, w, n, m)

    return PuModel(mean, std, minimise(at, prior, ridge), prior)


# ------------------------------------------------------------------ documents
FOLDS, HELD_OUT = 3, 1


def score_by_folds(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Learns from rows whose id is not in the held-out fold (a null id belongs to it); their trusted positives are the
    ids whose every label is 1. Scores lie between 0 and 1, for null and empty texts too, which count as empty.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                x = features_of([t or "" for t in part.column("_text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array([r.tobytes() for r in x], pa.binary())],
                                                 ["_id", "x"])

    trusted = (labels.groupBy(F.col(id_col).alias("_trusted")).agg(F.min(label_col).alias("_least"))
               .where("_least = 1").select("_trusted"))
    featured = write_stage(base.mapInArrow(run, f"_id {id_type}, x binary"), "quality_features")
    held_out = F.coalesce(fold("_id", FOLDS) == HELD_OUT, F.lit(True))
    rows = write_stage(featured.join(trusted, F.col("_id") == F.col("_trusted"), "left").select(
        "_id", "x", held_out.alias("held_out"), (F.col("_trusted").isNotNull() & ~held_out).alias("positive")),
        "quality_rows")
    model = fit(rows.where("NOT held_out").select("x", "positive"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, len(FEATURES))
            score = model.score(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.select("_id", "x", "held_out").mapInArrow(
        scored, f"doc_id {id_type}, held_out boolean, score double, predicted int")
