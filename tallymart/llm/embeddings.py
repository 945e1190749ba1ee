"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact cosines.

Equal vectors with equal labels form a class, and one of each class goes on. A rotation of the
principal axes, learnt on a bounded sample, balances the signs of the coordinates, which are the
bits of the code; every vector is coded. The code is cut into substrings, one hash table each; two
codes that differ in at most 2 * tables - 1 bits differ in at most one bit of some substring, so
each code asks every table for its substring and for those one bit away. What is found, within
``MOST_BITS``, is ranked again by the cosine of the original vectors in double precision.

Only equal labels are compared. Vectors that are null, empty, zero or hold a null or non-finite
component, and those without a label, link with nothing; nor do vectors of different lengths. Two
rows that repeat a vec_id are two vectors. A null vec_id never names a component unless it is alone.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.graph import components
from tallymart.sources.staging import stage

SIMILAR = 0.98
SAMPLE = 5000
BITS, TABLES = 64, 4
ROUNDS = 50
MOST_BITS = 16


@dataclass
class Quantiser:
    mean: np.ndarray
    rotation: np.ndarray  # (dimensions, bits)

    def code(self, vectors: np.ndarray) -> np.ndarray:
        width = len(self.mean)
        fitted = np.zeros((len(vectors), width))
        fitted[:, : vectors.shape[1]] = vectors[:, :width]
        bits = (fitted - self.mean) @ self.rotation > 0
        powers = np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64)
        return (bits * powers).sum(axis=1, dtype=np.uint64).view(np.int64)


def fit(vectors: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> Quantiser:
    """Turn the principal axes until the coordinates are as near to their signs as can be."""
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    projected = centred @ axes
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        signs = np.where(projected @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ projected)
        turn = (left @ right).T
    return Quantiser(mean, axes @ turn)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _coded(batches: Iterator[pa.RecordBatch], quantiser: Quantiser) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = np.zeros(batch.num_rows, np.int64)
        sizes = batch.column("dims").to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            codes[at] = quantiser.code(_unit(_matrix(batch.column("embedding").take(pa.array(at)))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes)], names=[*batch.schema.names, "code"])


def _cosines(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keep = np.zeros(batch.num_rows, bool)
        sizes = batch.column("dims").to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x, y = (_matrix(batch.column(c).take(pa.array(at))) for c in ("x", "y"))
            dot = (x * y).sum(axis=1)
            keep[at] = dot / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1)) >= similar
        yield batch.select(["a", "b", "ma", "mb"]).filter(pa.array(keep))


def link(
    vectors: DataFrame, similar: float = SIMILAR, sample: int = SAMPLE, tables: int = TABLES,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & finite & some, F.lit(False))
    rows = stage(
        vectors.select("vec_id", "label", "embedding").select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding",
            F.size("embedding").alias("dims"), usable.alias("usable"),
        ),
        "vectors",
    )
    key = F.struct(F.xxhash64("label", "embedding").alias("k1"), F.hash("label", "embedding").alias("k2"))
    keyed = rows.filter("usable").select("*", key.alias("key"))
    classes = keyed.groupBy("key").agg(
        F.min("row").alias("cid"), F.count("*").alias("copies"), F.min("vec_id").alias("low")
    )
    classes = stage(classes, "vector-classes")
    ones = keyed.join(classes.select(F.col("cid").alias("row"), "copies"), "row").select(
        F.col("row").alias("cid"), "label", "dims", "copies", "embedding"
    )
    learnt = ones.orderBy(F.xxhash64("embedding"), "cid").limit(sample).select("dims", "embedding").toArrow()
    sizes = learnt["dims"].to_numpy()
    if not len(sizes):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    size = np.bincount(sizes).argmax()
    quantiser = fit(_unit(_matrix(learnt["embedding"].combine_chunks().filter(pa.array(sizes == size)))))
    coded = stage(
        ones.mapInArrow(
            functools.partial(_coded, quantiser=quantiser),
            "cid long, label int, dims int, copies long, embedding array<float>, code long",
        ),
        "codes",
    )

    # each substring and, on the asking side, those one bit away
    width = BITS // tables
    table = F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("table")
    cut = F.expr(f"shiftrightunsigned(code, table * {width}) & {(1 << width) - 1}L")
    held = coded.select("cid", "label", "dims", "code", table).withColumn("part", cut)
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(width)))
    asked = held.select(
        "label", "dims", "table", F.col("cid").alias("b"), F.col("code").alias("code_b"),
        F.explode(F.transform(flips, lambda f: F.col("part").bitwiseXOR(f))).alias("part"),
    )
    near = F.bit_count(F.col("code").bitwiseXOR(F.col("code_b"))) <= MOST_BITS
    pairs = (
        held.join(asked, ["label", "dims", "table", "part"])
        .filter(F.col("cid") < F.col("b")).filter(near)
        .select(F.col("cid").alias("a"), "b").distinct()
    )
    x = coded.select(F.col("cid").alias("a"), "dims", F.col("copies").alias("ma"), F.col("embedding").alias("x"))
    y = coded.select(F.col("cid").alias("b"), F.col("copies").alias("mb"), F.col("embedding").alias("y"))
    links = stage(
        pairs.join(x, "a").join(y, "b").mapInArrow(
            functools.partial(_cosines, similar=similar), "a long, b long, ma long, mb long"
        ),
        "vector-links",
    )
    both = links.select(F.col("a").alias("cid"), F.col("mb").alias("n")).unionByName(
        links.select(F.col("b").alias("cid"), F.col("ma").alias("n"))
    )
    counted = both.groupBy("cid").agg(F.sum("n").alias("others"))
    named = components(links).select(F.col("id").alias("cid"), "component")
    known = stage(
        classes.join(counted, "cid", "left").join(named, "cid", "left").select(
            "key", "cid", "low", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "cid").alias("component"),
        ),
        "class-links",
    )
    lows = known.groupBy("component").agg(F.min("low").alias("component_id"))
    result = known.join(lows, "component").select("key", "n_links", "component_id")
    linked = keyed.join(result, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
