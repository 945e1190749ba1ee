"""Quality rules: plain counts, then a calibrated n-gram logistic regression at a fixed threshold.

The regression sees hashed unigrams and bigrams of words and hashed 3- and 5-grams of bytes, each
family as relative frequencies within its text. It is trained on a bounded sample of labelled rows
(the ``sample`` of least hash), two thirds for the weights and one third for Platt calibration, and
scores all texts in Arrow batches.

Nulls and empty texts: no words, so ``base_failed``. Labels that are null are not used; several
labels of a document count by their mean. Without labels of both kinds the probability is the mean
label, or 1 without any, so that the base rules alone decide. Repeated rows give repeated results;
further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.rows import doc_id
from tallymart.llm.text import SEPARATORS, Words, blocks, mix

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
KEEP_AT = 0.3
SAMPLE = 2000
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
WORD_GRAMS, BYTE_GRAMS = (1, 2), (3, 5)
FAMILIES = len(WORD_GRAMS) + len(BYTE_GRAMS)
SPREAD = 30.0
STEPS, RATE, DECAY = 120, 0.05, 1e-6

RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, probability double, kept boolean"
)

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each run between neighbouring bounds."""
    total = np.zeros(len(flags) + 1, np.float64 if flags.dtype.kind == "f" else np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Per text, the words in windows that are found at least twice in it."""
    grams, inside = words.grams(window)
    at = np.flatnonzero(inside)
    keys = mix(grams[at] + words.owner()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ranked = np.sort(keys)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    change = np.zeros(len(words) + 1, np.int64)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        hit = at[twice[place] == keys]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + window, -1)
    return per_text(np.cumsum(change[:-1]) > 0, words.word_bounds)


def duplicate_lines(text: str | None) -> int:
    lines = [line for line in (text or "").split("\n") if line.strip(SEPARATORS)]
    return len(lines) - len(set(lines))


def base_counts(words: Words, texts: list[str | None]) -> dict[str, np.ndarray]:
    character = (words.data & 0xC0) != 0x80
    return {
        "n_words": np.diff(words.word_bounds),
        "word_chars": per_text(
            character & ~np.isin(words.data, list(SEPARATORS.encode())), words.bounds
        ),
        "n_symbols": per_text(_IS_SYMBOL[words.data], words.bounds),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeated_words(words),
    }


# --- features -------------------------------------------------------------------------------


def families(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram family: bucket of each place, whether it counts, bounds of the texts."""
    for n in WORD_GRAMS:
        grams, inside = words.grams(n)
        bounds = np.minimum(words.word_bounds, len(grams))
        yield (grams & np.uint64(BUCKETS - 1)).astype(np.int64), inside, bounds
    left = np.repeat(words.bounds[1:], np.diff(words.bounds)) - np.arange(len(words.data))
    for n in BYTE_GRAMS:
        size = max(0, len(words.data) - n + 1)
        code = np.zeros(size, np.uint64)
        for i in range(n):
            code = code << np.uint64(8) | words.data[i : i + size].astype(np.uint64)
        code = code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)
        yield code.astype(np.int64), left[:size] >= n, np.minimum(words.bounds, size)


def sparse_rows(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, scaled relative frequencies) of each text."""
    parts = []
    for family, (bucket, counts, bounds) in enumerate(families(words)):
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            own, times = np.unique(bucket[a:b][counts[a:b]], return_counts=True)
            parts.append((i, own + family * BUCKETS, times * SPREAD / max(1, times.sum())))
    out = []
    for i in range(len(words.bounds) - 1):
        mine = [p for p in parts if p[0] == i]
        out.append((np.concatenate([p[1] for p in mine]), np.concatenate([p[2] for p in mine])))
    return out


# --- the model ------------------------------------------------------------------------------


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 1.0

    def probability(self, words: Words) -> np.ndarray:
        n = len(words.bounds) - 1
        margin = np.zeros(n)
        for family, (bucket, counts, bounds) in enumerate(families(words)):
            weight = self.weights[family * BUCKETS : (family + 1) * BUCKETS]
            total = per_text(np.where(counts, weight[bucket], 0.0), bounds)
            margin += SPREAD * total / np.maximum(1, per_text(counts, bounds))
        return sigmoid(self.slope * margin + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Logistic regression by Adam on two thirds of the rows, Platt calibration on the others."""
    weights = np.zeros(FAMILIES * BUCKETS)
    if not len(labels) or labels.min() == labels.max():
        mean = float(np.clip(labels.mean() if len(labels) else 1.0, 1e-6, 1 - 1e-6))
        return Model(weights, np.log(mean / (1 - mean)))
    own = np.arange(len(labels)) % 3 != 2
    if labels[own].min() == labels[own].max() or labels[~own].size < 10:
        own = np.ones(len(labels), bool)

    def stacked(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        picked = [rows[i] for i in np.flatnonzero(chosen)]
        lengths = np.array([len(p[0]) for p in picked])
        index = np.concatenate([p[0] for p in picked]).astype(np.int64)
        values = np.concatenate([p[1] for p in picked]).astype(np.float64)
        return index, values, np.repeat(np.arange(len(picked)), lengths)

    index, values, owner = stacked(own)
    target, n = labels[own], int(own.sum())
    bias, first, second = 0.0, np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(owner, values * weights[index], minlength=n) + bias
        error = (sigmoid(margin) - target) / n
        slope = np.bincount(index, values * error[owner], minlength=len(weights))
        gradient = np.append(slope + DECAY * weights, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    check = ~own if (~own).any() else own
    index, values, owner = stacked(check)
    margin = np.bincount(owner, values * weights[index], minlength=int(check.sum()))
    slope, offset = platt(margin, labels[check])
    return Model(weights, offset, slope)


def platt(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibrated log-odds, by Newton steps with softened labels."""
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0.5, (positive + 1) / (positive + 2), 1 / (negative + 2))
    design = np.column_stack([margin, np.ones(len(margin))])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(design @ theta)
        gradient = design.T @ (p - target)
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        theta = theta - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return max(float(theta[0]), 0.0), float(theta[1])


# --- Spark ----------------------------------------------------------------------------------


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, sample: int, allowed=None
) -> DataFrame:
    """The text and mean label of the ``sample`` labelled documents of least hash."""
    usable = labels.select("doc_id", F.col(label).cast("double").alias("_label")).dropna()
    if allowed is not None:
        usable = usable.filter(allowed)
    means = usable.groupBy("doc_id").agg(F.avg("_label").alias("_label"))
    chosen = means.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # so few may be broadcast
    return docs.select(doc_id(), "text").join(F.broadcast(chosen), "doc_id")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            rows = sparse_rows(Words(block.column("text")))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("_label")]
                + [pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary())]
                + [pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary())],
                names=["doc_id", "label", "index", "value"],
            )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, "quality", sample).mapInArrow(
        _features, "doc_id long, label double, index binary, value binary"
    )
    found = rows.toArrow().sort_by("doc_id")
    sparse = [
        (np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4"))
        for i, v in zip(found["index"].to_pylist(), found["value"].to_pylist())
    ]
    return fit(sparse, (found["label"].to_numpy() >= 0.5).astype(float))


def _score(batches: Iterator[pa.RecordBatch], model: Model, keep_at: float):
    for batch in batches:
        for block in blocks(batch, "text"):
            words = Words(block.column("text"))
            counts = base_counts(words, block.column("text").to_pylist())
            n, repeated = counts["n_words"], counts["n_repeat_words"]
            failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
            probability = model.probability(words)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in counts.values())]
                + [pa.array(failed), pa.array(probability)]
                + [pa.array(~failed & (probability >= keep_at))],
                names=["doc_id", *counts, "base_failed", "probability", "kept"],
            )


def quality_rules(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, keep_at: float = KEEP_AT
) -> DataFrame:
    """Counts, calibrated probability of good quality and the verdict for every document."""
    score = functools.partial(_score, model=train(docs, labels, sample), keep_at=keep_at)
    return docs.select(doc_id(), "text").mapInArrow(score, RESULT)
