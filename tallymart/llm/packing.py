"""Packing along a space-filling curve: documents that are near in content share sequences.

Each document's token counts, hashed into buckets, are projected to three dimensions by a fixed
random matrix; the coordinates, scaled by their mean and deviation over all documents, give a
Hilbert key. Documents follow each other in order of (key, doc_id), their ids form one stream, and
the stream is cut every ``length`` ids. So only the last sequence of the whole corpus is padded.

Only narrow rows are sorted; the ids of a document are moved once, to meet its place in the stream.
Equal documents have equal keys and are told apart by doc_id and row, so a large group of copies is
spread like any other rows. A null text is a document of one end id; repeated rows are packed as
often as they come; a null doc_id stays null; an empty table gives no sequences; further columns
are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tallymart.llm.rows import doc_id
from tallymart.llm.text import blocks, mix
from tallymart.llm.tokens import ENCODE_BYTES, END_ID, encoder, tokenizer_path
from tallymart.sources.staging import stage

DIMENSIONS = 3
BITS = 16
BUCKETS = 1024
AXES = [f"axis{i}" for i in range(DIMENSIONS)]
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def projection(buckets: int = BUCKETS) -> np.ndarray:
    """A fixed matrix of signs: row b is the direction of bucket b."""
    signs = mix(np.arange(1, buckets * DIMENSIONS + 1, dtype=np.uint64)) & np.uint64(1)
    return signs.astype(np.float32).reshape(buckets, DIMENSIONS) * 2 - 1


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with coordinates in [0, 2^bits), row by row.

    From the highest bit down, the cell of a point within its parent is a Gray code; the cell also
    says how the curve is reflected and which axes it swaps inside, and that is undone on the lower
    bits before the next step.
    """
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn = np.where((x[n - 1] >> b) & 1 == 1, turn ^ ((1 << b) - 1), turn)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ turn) >> b) & 1
    return key


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer_path(tokenizer)).encode_block
    compress = zstandard.ZstdCompressor(level=1).compress
    bucket = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
    directions = projection()[bucket]
    for batch in batches:
        for block in blocks(batch, "text", ENCODE_BYTES):
            ids, counts = encode(block.column("text"), END_ID)
            begins = np.cumsum(counts) - counts
            sums = np.add.reduceat(directions[ids & 0xFFFF], begins)
            axes = (sums / np.sqrt(counts)[:, None]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), block.column("doc_id"), pa.array(counts)]
                + [pa.array(axes[:, i]) for i in range(DIMENSIONS)]
                + [pa.array([compress(own.tobytes()) for own in np.split(ids, begins[1:])], pa.binary())],
                names=["row", "doc_id", "doc_tokens", *AXES, "ids"],
            )


@F.pandas_udf(LongType())
def _key(*axes: pd.Series) -> pd.Series:
    """Coordinates are in deviations from the mean; beyond four of them they meet at the border."""
    grid = np.column_stack(axes).clip(-4, 4)
    return pd.Series(hilbert_key(((grid + 4) / 8 * ((1 << BITS) - 1)).round()))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        counts = batch.column("doc_tokens").to_numpy()
        until = before + np.cumsum(counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.full(len(counts), part, np.int32)),
             batch.column("doc_tokens"), pa.array(until - counts)],
            names=["row", "part", "doc_tokens", "begin"],
        )
        before = int(until[-1]) if len(until) else before


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    decompress = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, n, begin, packed in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "begin", "ids"))
        ):
            ids = decompress(packed)
            edges = [begin, *range((begin // length + 1) * length, begin + n, length), begin + n]
            rows += [
                (doc_id, a - begin, b - a, n, a // length, a % length,
                 ids[4 * (a - begin) : 4 * (b - begin)])
                for a, b in zip(edges, edges[1:])
            ]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        columns = zip(*rows) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def pack(docs: DataFrame, length: int = 1024, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), doc_id(), "text")
    axes = ", ".join(f"{a} double" for a in AXES)
    tokens = stage(
        numbered.mapInArrow(
            functools.partial(_encode, tokenizer=tokenizer),
            f"row long, doc_id long, doc_tokens long, {axes}, ids binary",
        ),
        "tokens",
    )
    scale = tokens.agg(
        *(F.avg(a).alias(f"{a}_mean") for a in AXES),
        *(F.stddev_pop(a).alias(f"{a}_dev") for a in AXES),
    ).first()
    standard = [
        (F.col(a) - F.lit(scale[f"{a}_mean"] or 0.0)) / F.lit(scale[f"{a}_dev"] or 1.0)
        for a in AXES
    ]
    keyed = tokens.select("row", "doc_id", "doc_tokens", _key(*standard).alias("key"))
    order = stage(
        keyed.repartitionByRange("key", "doc_id", "row")
        .sortWithinPartitions("key", "doc_id", "row")
        .mapInArrow(_running, "row long, part int, doc_tokens long, begin long"),
        "curve-order",
    )
    # one row for each partition of the sort
    totals = order.groupBy("part").agg(F.sum("doc_tokens").alias("_tokens"))
    before = F.sum("_tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("_base"))
    places = order.join(F.broadcast(bases), "part").select(
        "row", (F.col("begin") + F.col("_base")).alias("begin")
    )
    joined = tokens.select("row", "doc_id", "doc_tokens", "ids").join(places, "row")
    return joined.select("doc_id", "doc_tokens", "begin", "ids").mapInArrow(
        functools.partial(_cut, length=length), PIECES
    )
