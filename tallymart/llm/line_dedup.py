"""Line dedup: every line that an earlier document has goes, by bitmaps of the lines to keep.

A line's key is the line without white space at both ends, A-Z in lower case. The 128-bit hashes of
long enough keys are range-partitioned with document and position as further sort columns, so one
line of a third of all documents is spread over many partitions. Each sorted partition is streamed:
the document of a key's first row keeps its lines, every later one loses them. A run of equal keys
that began in an earlier partition shows in one record a partition, the document in which its last
run starts; only the lines of the first document of a partition's first run wait for these records.

Results are bitmaps, zlib-compressed bits with the first line in the highest bit of the first byte,
1 for a line that stays. ``drop_lines`` applies them to the texts.

A null or empty text has one empty line. Rows of equal doc_id count as one document, rows with a
null doc_id as one after all others. Equal rows get equal results. Texts of any length are split
whole. An empty table gives an empty result; further columns are ignored by ``line_bitmaps`` and
kept, under ``row``, by ``drop_lines``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.llm.rows import keyed, real_id, row_names
from tallymart.llm.text import SEPARATORS, blocks
from tallymart.sources.staging import stage

LEAST_LENGTH = 10  # code points

_LINE = "h long, g long, did long, rk long, line int"
_FOUND = f"kind string, {_LINE}"
_ORDER = ("h", "g", "did", "rk", "line")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each line with a long enough key."""
    for batch in batches:
        for block in blocks(batch, "text"):
            lines = pc.split_pattern(block.column("text"), pattern="\n")
            text, owner = pc.list_flatten(lines), pc.list_parent_indices(lines).to_numpy(zero_copy_only=False)
            first = np.searchsorted(owner, np.arange(block.num_rows))
            line = np.arange(len(owner)) - first[owner]
            key = pc.ascii_lower(pc.utf8_trim(text, characters=SEPARATORS))
            long = pc.greater_equal(pc.utf8_length(key), LEAST_LENGTH)
            at = np.flatnonzero(long.to_numpy(zero_copy_only=False))
            digests = b"".join(map(xxhash.xxh3_128_digest, key.filter(long).to_pylist()))
            h, g = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2).T
            rows = pa.array(owner[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(g), block.column("did").take(rows), block.column("rk").take(rows),
                 pa.array(line[at].astype(np.int32))],
                list(_ORDER),
            )


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to drop, those whose key an earlier partition may hold, and the last run of the partition.

    Rows come in order. ``first`` is the document that begins the current run of equal keys.
    """
    key, first, opening = None, 0, True
    for batch in batches:
        h, g, did = (batch.column(c).to_numpy() for c in _ORDER[:3])
        if not len(h):
            continue
        changed = np.empty(len(h), bool)
        changed[0] = key is not None and key != (h[0], g[0])
        changed[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        if key is None:
            first = did[0]
        starts = np.flatnonzero(changed)
        firsts = np.concatenate([[first], did[starts]])[np.cumsum(changed)]
        later = did > firsts
        waiting = np.zeros(len(h), bool)
        if opening:
            until = starts[0] if len(starts) else len(h)
            waiting[:until] = ~later[:until]
            opening = not len(starts)
        for kind, chosen in (("drop", later), ("wait", waiting)):
            if chosen.any():
                rows = batch.filter(pa.array(chosen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * rows.num_rows), *(rows.column(c) for c in _ORDER)], ["kind", *_ORDER]
                )
        key, first = (h[-1], g[-1]), firsts[-1]
    if key is not None:
        values = [["last"], [int(key[0])], [int(key[1])], [int(first)], [0], [0]]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["kind", *_ORDER])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dropped lines of a document as a compressed bitmap, up to the byte of the last of them."""
    for batch in batches:
        packed = []
        for lines in batch.column("lines"):
            at = lines.values.to_numpy()
            keep = np.ones(int(at.max()) // 8 * 8 + 8, np.uint8)
            keep[at] = 0
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("did"), batch.column("rk"), pc.list_value_length(batch.column("lines")).cast(pa.int64()),
             pa.array(packed, pa.binary())],
            ["did", "rk", "n_dropped", "bits"],
        )


def _losses(docs: DataFrame) -> DataFrame:
    """did, rk, n_dropped and bitmap of the documents that lose lines."""
    lines = keyed(docs).mapInArrow(_keys, _LINE)
    found = stage(
        lines.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).mapInArrow(_stream, _FOUND), "lines"
    )
    # one row for each partition of the sort
    runs = found.filter("kind = 'last'").groupBy("h", "g").agg(F.min("did").alias("_first"))
    waited = found.filter("kind = 'wait'").join(F.broadcast(runs), ["h", "g"]).filter("did > _first")
    dropped = found.filter("kind = 'drop'").select("did", "rk", "line").unionByName(waited.select("did", "rk", "line"))
    gathered = dropped.groupBy("did", "rk").agg(F.collect_set("line").alias("lines"))
    return gathered.mapInArrow(_pack, "did long, rk long, n_dropped long, bits binary")


def kept_lines(text: str, bits: bytes | None) -> str:
    """The lines of which the bitmap has a 1; lines behind its end stay."""
    if bits is None:
        return text
    flags = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))
    lines = text.split("\n")
    return "\n".join(line for i, line in enumerate(lines) if i >= len(flags) or flags[i])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            kept = map(kept_lines, block.column("text").to_pylist(), block.column("bits").to_pylist())
            columns = [block.column(c) for c in ("row", "n_lines", "n_dropped")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.string())], ["row", "n_lines", "n_dropped", "kept"]
            )


def _n_lines() -> Column:
    breaks = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return (breaks + 1).cast("long").alias("n_lines")


def line_bitmaps(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and ``keep_bits`` of every document; null bits: all lines stay."""
    narrow = keyed(docs).select("did", "rk", _n_lines())
    return narrow.join(_losses(docs), ["did", "rk"], "left").select(
        real_id("did").alias("doc_id"), "n_lines", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        F.col("bits").alias("keep_bits"),
    )


def drop_lines(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` with the carried columns, n_lines, n_dropped and the kept text of every document."""
    names = {n: c.alias(n) for n, c in row_names().items()}
    texts = docs.select(
        *names.values(), F.struct(*carry).alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )
    joined = texts.join(_losses(docs), ["did", "rk"], "left").select(
        "row", _n_lines(), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "text", "bits"
    )
    kinds = T.StructType([joined.schema[c] for c in ("row", "n_lines", "n_dropped")]).add("kept", "string")
    return joined.mapInArrow(_apply, kinds)
