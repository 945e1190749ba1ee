"""Token files: fixed-size blocks of ids, transposed into bit or byte planes, zstandard per plane.

A shard file holds the ids of a run of documents in ascending (doc_id, text hash) order::

    planes of block 0 | planes of block 1 | ... | index | length of the index (8 bytes) | magic

Every plane is a zstandard frame; a plane of zeros takes no bytes. The index is an Arrow stream of
two record batches in one frame: blocks (ids, plane lengths) and documents (doc_id, ids). Shards
are written under names of their own by each attempt of a task; the manifest, a Parquet table that
Spark commits, names those that count, so a lost executor leaves nothing behind that is read.

Nulls: a null text has no ids of its own; documents with a null doc_id come last. Repeated rows
are repeated documents. An empty table gives an empty manifest. Further columns are ignored.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.rows import doc_id
from tallymart.llm.text import blocks
from tallymart.llm.tokens import ENCODE_BYTES, END_ID, encoder, tokenizer_path

BLOCK_IDS = 1 << 16
LEVEL = 3
MAGIC = b"IDPLANE1"
MANIFEST = "file string, part int, documents long, ids long, bytes long"


# --- blocks ---------------------------------------------------------------------------------


def split_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """Bit (or byte) planes of unsigned 32-bit ids, lowest first; zero planes are empty."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if unit == "byte":
        planes = table.T
    else:
        table = table[:, : max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)]
        bits = np.unpackbits(np.ascontiguousarray(table), axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return [np.ascontiguousarray(p).tobytes() if p.any() else b"" for p in planes]


def join_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    if unit == "byte":
        table = np.zeros((4, n), np.uint8)
        for row, plane in zip(table, planes):
            if plane:
                row[:] = np.frombuffer(plane, np.uint8)
        return np.ascontiguousarray(table.T).view("<u4").ravel()
    ids = np.zeros(n, "<u4")
    for place, plane in enumerate(planes):
        if plane:
            bits = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
            ids |= bits.astype("<u4") << np.uint32(place)
    return ids


def _index(kept: list[tuple[int, list[int]]], documents: list[tuple[int | None, int]]) -> bytes:
    sink = pa.BufferOutputStream()
    for rows, schema in (
        ([{"ids": n, "planes": p} for n, p in kept],
         pa.schema([("ids", pa.int64()), ("planes", pa.list_(pa.int64()))])),
        ([{"doc_id": d, "ids": n} for d, n in documents],
         pa.schema([("doc_id", pa.int64()), ("ids", pa.int64())])),
    ):
        with pa.ipc.new_stream(sink, schema) as stream:
            stream.write_table(pa.Table.from_pylist(rows, schema))
    return zstandard.compress(sink.getvalue().to_pybytes(), LEVEL)


# --- one task -------------------------------------------------------------------------------


def _write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, unit: str, block_ids: int
) -> Iterator[pa.RecordBatch]:
    encode = encoder(tokenizer_path(tokenizer)).encode_block
    part = TaskContext.get().partitionId()
    store, root = fs.FileSystem.from_uri(folder)
    name = f"{part:08d}-{uuid.uuid4().hex}.ids"
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    waiting, kept, documents, out, total, size = [], [], [], None, 0, 0

    def flush(least: int) -> None:
        nonlocal waiting, size
        ids = np.concatenate(waiting) if waiting else np.zeros(0, "<u4")
        begin = 0
        while len(ids) - begin >= max(1, least):
            block = ids[begin : begin + block_ids]
            frames = [compress(p) if p else b"" for p in split_planes(block, unit)]
            for frame in frames:
                out.write(frame)
            size += sum(map(len, frames))
            kept.append((len(block), list(map(len, frames))))
            begin += len(block)
        waiting = [ids[begin:].copy()]

    for batch in batches:
        if batch.num_rows and out is None:
            store.create_dir(root, recursive=True)
            out = store.open_output_stream(f"{root}/{name}")
        for block in blocks(batch, "text", ENCODE_BYTES):
            ids, counts = encode(block.column("text"), END_ID)
            documents += zip(block.column("doc_id").to_pylist(), counts.tolist())
            waiting.append(ids)
            total += len(ids)
            flush(block_ids)
    if out is not None:
        flush(1)
        index = _index(kept, documents)
        out.write(index + len(index).to_bytes(8, "little") + MAGIC)
        out.close()
        row = [f"{folder}/{name}", part, len(documents), total, size + len(index) + 16]
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[0]]), pa.array([part], pa.int32()), *(pa.array([x]) for x in row[2:])],
            names=["file", "part", "documents", "ids", "bytes"],
        )


def read_shard(file: str, unit: str) -> Iterator[tuple[int | None, int, bytes]]:
    """(doc_id, ids before it in the shard, its ids) of every document, block by block."""
    store, path = fs.FileSystem.from_uri(file)
    size = store.get_file_info(path).size
    decompress = zstandard.ZstdDecompressor().decompress
    with store.open_input_file(path) as source:
        source.seek(size - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{file} is not a token file")
        length = int.from_bytes(tail[:8], "little")
        source.seek(size - 16 - length)
        index = pa.BufferReader(decompress(source.read(length)))
        kept, documents = (pa.ipc.open_stream(index).read_all() for _ in range(2))
        source.seek(0)
        ready, begin, start = np.zeros(0, "<u4"), 0, 0
        block = iter(zip(kept["ids"].to_pylist(), kept["planes"].to_pylist()))
        for doc_id, n in zip(documents["doc_id"].to_pylist(), documents["ids"].to_pylist()):
            parts = [ready[begin : begin + n]]
            missing, begin = n - len(parts[0]), begin + n
            while missing:
                count, lengths = next(block)
                frames = [source.read(x) for x in lengths]
                ready = join_planes([decompress(f) if f else b"" for f in frames], count, unit)
                parts.append(ready[:missing])
                begin, missing = len(parts[-1]), missing - len(parts[-1])
            yield doc_id, start, b"".join(p.tobytes() for p in parts)
            start += n


def _read_shards(
    batches: Iterator[pa.RecordBatch], unit: str, rows: int = 256
) -> Iterator[pa.RecordBatch]:
    def batch(found: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["doc_id", "start", "ids"]
        )

    for shards in batches:
        for file, before in zip(
            shards.column("file").to_pylist(), shards.column("before").to_pylist()
        ):
            found = []
            for doc_id, start, ids in read_shard(file, unit):
                found.append((doc_id, before + start, ids))
                if len(found) == rows:
                    yield batch(found)
                    found = []
            if found:
                yield batch(found)


# --- tables ---------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str = "byte_bpe_50k.json", unit: str = "bit",
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Write all documents and return the manifest, which is stored beside the files."""
    ordered = (
        docs.select(doc_id(), "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange(F.col("doc_id").asc_nulls_last(), "_tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "_tie")
        .select("doc_id", "text")
    )
    write = functools.partial(
        _write_shard, folder=folder, tokenizer=tokenizer, unit=unit, block_ids=block_ids
    )
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, unit: str = "bit") -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of every document in the files."""
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("file", F.coalesce(before, F.lit(0)).alias("before"))  # one row a shard
    spread = shards.repartition(max(1, manifest.count()))
    read = functools.partial(_read_shards, unit=unit)
    return spread.mapInArrow(read, "doc_id long, start long, ids binary")
