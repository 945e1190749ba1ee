"""Language identification by string kernels, Nyström landmarks and kernel ridge regression.

The kernel of two texts is the number of 2-, 3- and 4-byte strings that both contain (hashed into
buckets, presence only), divided by the geometric mean of how many each contains. Landmark texts
span the Nyström feature space; a ridge regression per language, one against the rest, is solved
there. Since the kernel is linear in the presence vectors, the landmarks and the regressions fold
into one matrix, and a block of texts is scored by one product of its presence matrix with it.

Training takes a bounded sample: about ``per_language`` texts of each language, of least hash, with
a language and crc32(doc_id) mod 5 not 0. lang, source and doc_id never enter a prediction.

A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing could
be learnt. Repeated rows give repeated results; further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.quality_trees import held_out
from tallymart.llm.rows import doc_id
from tallymart.llm.text import blocks, utf8

GRAMS = (2, 3, 4)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
PER_LANGUAGE = 300
LANDMARKS = 256
RIDGE = 1e-2
SHARPNESS = 4.0
UNKNOWN = "und"
PREDICTION = "doc_id long, held_out boolean, lang_pred string, score double"
#: Texts of one presence matrix at most, so that it stays below 10 MB.
ROWS = 256



def presence(texts: pa.Array) -> np.ndarray:
    """Which buckets of byte strings each text contains, as a boolean matrix."""
    data, bounds = utf8(texts)
    out = np.zeros((len(texts), BUCKETS), bool)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    code = data.astype(np.uint64)
    for n in range(2, max(GRAMS) + 1):
        size = max(0, len(data) - n + 1)
        code = code[:size] << np.uint64(8) | data[n - 1 : n - 1 + size].astype(np.uint64)
        if n in GRAMS:
            marked = code + np.uint64(n << 40)
            bucket = marked * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)
            inside = left[:size] >= n
            out[owner[:size][inside], bucket[inside].astype(np.int64)] = True
    return out


def unit(present: np.ndarray) -> np.ndarray:
    """Rows scaled so that their product is the normalised kernel."""
    size = present.sum(axis=1, keepdims=True)
    return present.astype(np.float32) / np.sqrt(np.maximum(size, 1)).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages)
    offset: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        letters = np.array([any(map(str.isalpha, t or "")) for t in texts.to_pylist()], bool)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        margin = (unit(presence(texts)) @ self.weights).astype(np.float64) + self.offset
        likely = np.exp(SHARPNESS * (margin - margin.max(axis=1, keepdims=True)))
        score = np.where(letters, 1 / likely.sum(axis=1), 0.0)
        best = margin.argmax(axis=1)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)], score


def fit(present: np.ndarray, languages: list[str], landmarks: int = LANDMARKS) -> Model:
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rows = unit(present)
    # landmarks are taken evenly over the languages
    order = np.argsort(np.array([names.index(x) for x in languages]), kind="stable")
    marks = rows[order[np.linspace(0, len(order) - 1, min(landmarks, len(order))).astype(int)]]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    usable = values > values.max() * 1e-6
    root = vectors[:, usable] / np.sqrt(values[usable])
    phi = (rows @ marks.T).astype(np.float64) @ root
    target = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # rare languages weigh as much as common ones
    weight = np.array([1 / languages.count(x) for x in languages])
    weight = weight / weight.sum()
    center, level = weight @ phi, weight @ target
    phi, target = phi - center, target - level
    system = phi.T @ (phi * weight[:, None]) + RIDGE / len(languages) * np.eye(phi.shape[1])
    solved = np.linalg.solve(system, phi.T @ (target * weight[:, None]))
    return Model(names, (marks.T @ (root @ solved)).astype(np.float32), level - center @ solved)


def _presence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            block = batch.slice(begin, ROWS)
            bits = np.packbits(presence(block.column("text")), axis=1)
            yield pa.RecordBatch.from_arrays(
                [block.column("tie"), block.column("lang"),
                 pa.array([b.tobytes() for b in bits], pa.binary())],
                names=["tie", "lang", "bits"],
            )


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, BUCKETS), bool), [])
    # the share of each language's hashes that gives about the wanted number of texts
    buckets = 1 << 30
    shares = F.create_map(
        *(F.lit(x) for k, n in counts.items() for x in (k, min(buckets, per_language * buckets // n)))
    )
    tie = F.xxhash64("doc_id", "text")
    chosen = usable.filter(F.pmod(tie, F.lit(buckets)) < shares[F.col("lang")])
    found = chosen.select(tie.alias("tie"), "lang", "text").mapInArrow(
        _presence_rows, "tie long, lang string, bits binary"
    ).toArrow().sort_by([("tie", "ascending"), ("lang", "ascending")])
    bits = np.frombuffer(b"".join(found["bits"].to_pylist()), np.uint8).reshape(-1, BUCKETS // 8)
    return fit(np.unpackbits(bits, axis=1).astype(bool), found["lang"].to_pylist())


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in blocks(batch, "text"):
            for begin in range(0, run.num_rows, ROWS):
                block = run.slice(begin, ROWS)
                names, score = model.predict(block.column("text"))
                at = block.schema.get_field_index("text")
                rest = [c for i, c in enumerate(block.columns) if i != at]
                fields = [f for i, f in enumerate(block.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(names, pa.string()), pa.array(score)],
                    names=[*fields, "lang_pred", "score"],
                )


def predict_language(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every document."""
    predict = functools.partial(_predict, model=train(docs, per_language))
    return docs.select(doc_id(), held_out().alias("held_out"), "text").mapInArrow(predict, PREDICTION)


def keep_languages(
    docs: DataFrame, least_score: float = 0.4, per_language: int = PER_LANGUAGE
) -> DataFrame:
    """The documents, all their columns, whose language is known with ``least_score``."""
    model = train(docs, per_language)
    keep = functools.partial(_keep, model=model, least_score=least_score)
    return docs.mapInArrow(keep, docs.schema)


def _keep(
    batches: Iterator[pa.RecordBatch], model: Model, least_score: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in blocks(batch, "text"):
            for begin in range(0, run.num_rows, ROWS):
                block = run.slice(begin, ROWS)
                names, score = model.predict(block.column("text"))
                known = np.array([name != UNKNOWN for name in names], bool)
                yield block.filter(pa.array(known & (score >= least_score)))
