"""Names for the rows of a table of documents, and runs of rows in sorted partitions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a null doc_id: after all others.
NO_ID = (1 << 63) - 1

_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
    "double": pa.float64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def doc_id() -> Column:
    """The id as a 64-bit number, whatever whole number it is stored as."""
    return F.col("doc_id").cast("long").alias("doc_id")


def row_names() -> dict[str, Column]:
    """did and rk name a document and its text: they are equal for repeated rows only."""
    return {
        "did": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "rk": F.xxhash64("doc_id", "text"),
    }


def keyed(docs: DataFrame) -> DataFrame:
    """did, rk and the text, empty for null."""
    names = row_names()
    return docs.select(
        *(c.alias(n) for n, c in names.items()), F.coalesce("text", F.lit("")).alias("text")
    )


def real_id(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def to_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(column.split() for column in schema.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names=list(names)
    )


def groups(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[list[dict]]:
    """Runs of rows with equal keys, which arrive next to each other."""
    run: list[dict] = []
    at: tuple | None = None
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in key)
            if run and now != at:
                yield run
                run = []
            at = now
            run.append(row)
    if run:
        yield run
