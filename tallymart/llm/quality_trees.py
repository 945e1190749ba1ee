"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

The trees are complete binary trees of equal depth, kept as flat arrays, so that all documents of a
block walk through all trees in ``DEPTH`` vectorised steps. They are fitted on a bounded sample of
labelled rows (the ``sample`` of least hash among those whose crc32(doc_id) mod 5 is not 0), of
which only the statistics reach the driver.

Null and empty texts have statistics of zero and get a score like any other. Null labels are not
used; several labels of a document count by their mean. Without labels of both kinds every score is
the mean label, or 0.5 without any. Repeated rows give repeated results; further columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.quality_rules import (
    duplicate_lines, labelled_sample, per_text, repeated_words, sigmoid,
)
from tallymart.llm.rows import doc_id
from tallymart.llm.text import Words, blocks, mix

SAMPLE = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, RIDGE, LEAST_ROWS = 0.12, 1.0, 10
CUT = 0.3

STATISTICS = (
    "log_words", "log_bytes", "word_length", "word_spread", "symbols", "digits", "capitals",
    "marks", "foreign", "newlines", "distinct", "distinct_pairs", "same_as_last", "one_byte_words",
    "bar_words", "dup_lines", "repeated",
)

_BYTES = np.arange(256)
_KINDS = {
    "symbols": np.isin(_BYTES, list(b"#*$%&|<>@{}[]\\^~=+_/")),
    "digits": np.isin(_BYTES, list(b"0123456789")),
    "capitals": (_BYTES >= 65) & (_BYTES <= 90),
    "marks": np.isin(_BYTES, list(b".,;:!?'\"()-")),
    "foreign": _BYTES >= 128,
    "newlines": _BYTES == 10,
}


def held_out(column: str = "doc_id"):
    """Rows kept from learning: the remainder of crc32(doc_id as text) by 5 is 0."""
    checksum = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(checksum % 5 == 0, F.lit(False))


def _distinct(hashes: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    keys = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[order[1:]] = keys[order[1:]] != keys[order[:-1]]
    return per_text(new, bounds)


def statistics(words: Words, texts: list[str | None]) -> np.ndarray:
    """One row of STATISTICS per text."""
    n, size = np.diff(words.word_bounds), np.diff(words.bounds)
    some, long = np.maximum(1, n), np.maximum(1, size)
    owner, lengths = words.owner(), (words.ends - words.starts).astype(np.float64)
    mean = per_text(lengths, words.word_bounds) / some
    square = per_text(lengths**2, words.word_bounds) / some
    pairs, inside = words.grams(2)
    follows = np.zeros(len(words), bool)
    follows[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    one = lengths == 1
    bar = one & (words.data[words.starts] == ord("|")) if len(words) else one
    pair_owner = np.where(inside, owner[: len(pairs)], len(n) + np.arange(len(pairs)))
    pair_bounds = np.minimum(words.word_bounds, len(pairs))
    lines = np.array([(t or "").count("\n") + 1 for t in texts], np.float64)
    columns = {
        "log_words": np.log1p(n),
        "log_bytes": np.log1p(size),
        "word_length": mean,
        "word_spread": np.sqrt(np.maximum(0, square - mean**2)),
        **{k: per_text(flag[words.data], words.bounds) / long for k, flag in _KINDS.items()},
        "distinct": _distinct(words.hashes, owner, words.word_bounds) / some,
        "distinct_pairs": _distinct(pairs, pair_owner, pair_bounds) / some,
        "same_as_last": per_text(follows, words.word_bounds) / some,
        "one_byte_words": per_text(one, words.word_bounds) / some,
        "bar_words": per_text(bar, words.word_bounds) / some,
        "dup_lines": np.array([duplicate_lines(t) for t in texts]) / lines,
        "repeated": repeated_words(words) / some,
    }
    return np.column_stack([columns[name] for name in STATISTICS]).astype(np.float64)


# --- trees ----------------------------------------------------------------------------------


@dataclass
class Trees:
    """Inner node i of a tree has children 2i+1 and 2i+2; leaves follow the inner nodes."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, leaves)
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        trees = np.arange(len(self.feature))[None, :]
        rows = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        return sigmoid(self.leaf[trees, node - inner].sum(axis=1) + self.start)


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost on the logistic loss; splits come from histograms of gradients and curvatures."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not len(y) or y.min() == y.max():
        mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        empty = np.zeros((1, inner))
        start = np.log(mean / (1 - mean))
        return Trees(empty.astype(np.int64), empty, np.zeros((1, leaves)), start)
    width = x.shape[1]
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T  # (features, BINS - 1)
    binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T)], axis=1)
    offsets = np.arange(width) * BINS
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), start)
    out = Trees(
        np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
        np.zeros((trees, leaves)), start,
    )
    for t in range(trees):
        p = sigmoid(margin)
        gradient, curve = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            cell = ((node - first)[:, None] * width * BINS + offsets + binned).ravel()
            shape = (count, width, BINS)

            def histogram(values: np.ndarray) -> np.ndarray:
                spread = np.repeat(values, width)
                return np.bincount(cell, spread, minlength=np.prod(shape)).reshape(shape)

            g, h, n = (histogram(v).cumsum(axis=2) for v in (gradient, curve, np.ones(len(y))))
            total_g, total_h, total_n = (a[:, :, -1:] for a in (g, h, n))
            gain = (
                g**2 / (h + RIDGE) + (total_g - g) ** 2 / (total_h - h + RIDGE)
                - total_g**2 / (total_h + RIDGE)
            )
            small = (n < LEAST_ROWS) | (total_n - n < LEAST_ROWS)
            gain = np.where(small, -np.inf, gain)[:, :, : BINS - 1].reshape(count, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(count), best] > 1e-9
            feature, bin_ = best // (BINS - 1), best % (BINS - 1)
            at = slice(first, first + count)
            out.feature[t, at] = np.where(split, feature, 0)
            out.threshold[t, at] = np.where(split, edges[feature, bin_], np.inf)
            node = 2 * node + 1 + (x[np.arange(len(y)), out.feature[t, node]] > out.threshold[t, node])
        leaf = node - inner
        sums = np.bincount(leaf, gradient, minlength=leaves)
        out.leaf[t] = -RATE * sums / (np.bincount(leaf, curve, minlength=leaves) + RIDGE)
        margin += out.leaf[t, leaf]
    return out


# --- Spark ----------------------------------------------------------------------------------


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            rows = statistics(Words(block.column("text")), block.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("_label"), pa.array(rows.tolist(), pa.list_(pa.float64()))],
                names=["doc_id", "label", "x"],
            )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    rows = labelled_sample(docs, labels, "quality", sample, ~held_out()).mapInArrow(
        _statistics, "doc_id long, label double, x array<double>"
    )
    found = rows.toArrow().sort_by("doc_id")
    x = np.array(found["x"].to_pylist()).reshape(-1, len(STATISTICS))
    return fit(x, (found["label"].to_numpy() >= 0.5).astype(float))


def _score(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            texts = block.column("text")
            score = trees.score(statistics(Words(texts), texts.to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("held_out"), pa.array(score),
                 pa.array((score >= CUT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (likelihood of quality 1) and predicted for every document."""
    score = functools.partial(_score, trees=train(docs, labels, sample))
    return docs.select(doc_id(), "text", held_out().alias("held_out")).mapInArrow(
        score, "doc_id long, held_out boolean, score double, predicted int"
    )
