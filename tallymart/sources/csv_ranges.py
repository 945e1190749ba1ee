"""CSV files whose quoted cells may hold line breaks, each file read by many tasks.

Spark deals out byte ranges of a file, cut at line breaks. Whether a range begins within a quoted
cell is only known from all that lies before it, so the work has two passes. The first reduces
every range to a map: the state at its end if it begins outside a cell, and if it begins inside.
Such a map keeps, flips or sets the state, and a running composition over the ranges of a file
gives the true state at each range's start. The second pass joins lines to records from there.
A record that crosses the end of a range comes in fragments, one from each range, which are put
together by a third, small step; they are cut out in a pass of their own over the ranges that have
any. All passes see lines in file order within a range, work on a batch of lines in Arrow kernels and
hold no more than that and one record.

A quote opens a cell only at the cell's start, is doubled within it, and what follows a closing
quote belongs to the cell up to the next comma. An unclosed cell reaches to the end of its file.
Lines of blanks alone are no records. The first record of a file is its header.
"""

from __future__ import annotations

import csv
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"

_MAPS = "file string, block long, from_outside boolean, from_inside boolean"
_RECORDS = "file string, block long, row long, kind string, record string"
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_END = (1 << 63) - 1  # behind all ranges

# Lines that end outside a cell, if they begin outside and if they begin inside; see ``ends_inside``.
_CLOSES = r'(?:[^"]|"")*"(?:[^",][^,]*)?'
_CELL = f'(?:"{_CLOSES}|(?:[^",][^,]*)?)'
_ENDS_OUTSIDE = f"^{_CELL}(?:,{_CELL})*$", f"^{_CLOSES}(?:,{_CELL})*$"


def _closed(line: str, at: int) -> int:
    """Behind the quote that closes a cell whose text begins at ``at``; -1 if none does."""
    while True:
        at = line.find('"', at)
        if at < 0:
            return -1
        if line[at + 1 : at + 2] != '"':
            return at + 1
        at += 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of the line."""
    at = 0
    while at >= 0:
        if inside or line.startswith('"', at):
            at = _closed(line, at if inside else at + 1)
            if at < 0:
                return True
            inside = False
        at = line.find(",", at)
        at += at >= 0
    return False


def _line_maps(lines: pa.Array) -> list[np.ndarray]:
    """``ends_inside`` of all lines, if they begin outside a cell and if they begin inside."""
    cells = lines.cast(pa.binary())
    return [~pc.match_substring_regex(cells, form).to_numpy(zero_copy_only=False) for form in _ENDS_OUTSIDE]


def _after(maps: list[np.ndarray], inside: bool) -> np.ndarray:
    """The state at the end of each line, of which the first begins in the state ``inside``."""
    outer, inner = maps
    flips = np.cumsum(outer & ~inner)
    # the last line that sets the state, whatever it was, and the flips since then
    last = np.maximum.accumulate(np.where(outer == inner, np.arange(len(outer)), -1))
    since = flips - np.where(last < 0, 0, flips[last])
    return np.where(last < 0, inside, outer[last]) ^ (since % 2 == 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of each range in a batch; a range may go on in the next batch."""
    for batch in batches:
        file, block = batch.column("file"), batch.column("block")
        if not batch.num_rows:
            continue
        changed = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
        cuts = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield file[a].as_py(), block[a].as_py(), batch.column("value").slice(a, b - a)


# --- first pass -----------------------------------------------------------------------------


def _range_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at the end of each range; only lines with quotes come here."""
    current, states = None, (False, True)
    for file, block, lines in _runs(batches):
        if current != (file, block):
            if current:
                yield _batch([(*current, *states)], _MAPS)
            current, states = (file, block), (False, True)
        maps = _line_maps(lines)
        states = tuple(bool(_after(maps, state)[-1]) for state in states)
    if current:
        yield _batch([(*current, *states)], _MAPS)


def _left_open(lines: DataFrame) -> dict[str, list[tuple[int, int]]]:
    """By file, the ranges that a cell is open at the end of, each with the next range that has quotes.

    Ranges from behind the first to the second begin within the cell. There is at most one row for
    a task of the scan, whose list the driver holds anyway.
    """
    maps = lines.filter(F.contains("value", F.lit('"'))).mapInArrow(_range_maps, _MAPS)
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("from_outside") == F.col("from_inside")
    flips = F.sum((~F.col("sets") & F.col("from_outside")).cast("int")).over(order)
    mapped = maps.withColumn("sets", sets).withColumn("flips", flips)
    # the last range that sets the state, whatever it was, and the flips since then
    last = F.last(F.when(F.col("sets"), F.struct("from_outside", "flips")), ignorenulls=True).over(earlier)
    since = F.coalesce(F.lag("flips").over(order), F.lit(0)) - F.coalesce(last["flips"], F.lit(0))
    inside = F.coalesce(last["from_outside"], F.lit(False)) != (since % 2 == 1)
    leaves = F.when(inside, F.col("from_inside")).otherwise(F.col("from_outside"))
    spans = mapped.select("file", "block", leaves.alias("leaves"), F.lead("block").over(order).alias("until"))
    found: dict[str, list[tuple[int, int]]] = {}
    for row in spans.filter("leaves").collect():
        found.setdefault(row["file"], []).append((row["block"], _END if row["until"] is None else row["until"]))
    return found


# --- second pass ----------------------------------------------------------------------------


def _records(
    batches: Iterator[pa.RecordBatch], left_open: dict[str, list[tuple[int, int]]], names: list[str] | None, crossing: bool = False
) -> Iterator[pa.RecordBatch]:
    """Records that lie within a range or, if ``crossing``, the fragments of those that cross its ends.

    ``kind`` is ``head`` for the header of a file, ``whole`` for other records, ``open`` for the first
    fragment of a record, ``on`` for one that does not end it and ``end`` for the last.
    """
    current, inside, lead, row, pending = None, False, False, 0, []

    def fragment(kind: str, record: str) -> pa.RecordBatch:
        return _batch([(*current, row, kind, record)], _RECORDS)

    def leave() -> Iterator[pa.RecordBatch]:
        if pending and crossing:
            yield fragment("on" if lead else "open", "\n".join(pending))

    for file, block, lines in _runs(batches):
        if current != (file, block):
            yield from leave()
            opened = left_open.get(file, [])
            inside = any(after < block <= until for after, until in opened)
            crosses = inside or any(after == block for after, _ in opened)
            current, lead, row, pending = (file, block), inside, 0, []
        if crossing and not crosses:
            continue
        before, after = inside, np.full(len(lines), inside)
        if pc.any(pc.match_substring(lines, '"')).as_py():
            after = _after(_line_maps(lines), inside)
        inside = bool(after[-1])
        ends = np.flatnonzero(~after)
        if not len(ends):
            pending += lines.to_pylist()
            continue
        # a line of blanks is no record, but may belong to one
        alone = ~np.concatenate([[before], after[:-1]])[ends]
        blank = pc.equal(pc.utf8_trim_whitespace(lines.take(pa.array(ends))), "").to_numpy(zero_copy_only=False)
        keep = ~(alone & blank)
        n, behind = int(keep.sum()), int(ends[-1]) + 1
        first, pending, led = pending, lines[behind:].to_pylist(), lead
        lead = False
        if crossing:
            if led:
                yield fragment("end", "\n".join([*first, *lines[: int(ends[0]) + 1].to_pylist()]).removesuffix("\r"))
            row += n
            continue
        texts = lines[:behind]
        if len(ends) < behind:
            starts = pa.array(np.concatenate([[0], ends + 1]), pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(starts, texts), "\n")
        if first:
            whole = "\n".join([*first, texts[0].as_py()])
            texts = pa.concat_arrays([pa.array([whole], texts.type), texts[1:]])
        if n < len(ends):
            texts = texts.filter(pa.array(keep))
        if pc.any(pc.ends_with(texts, "\r")).as_py():
            texts = pc.replace_substring_regex(texts, pattern=r"\r$", replacement="")
        numbers, kinds = np.arange(row, row + n), pa.repeat(pa.scalar("whole"), n)
        row += n
        if led:  # the end of a record that began in an earlier range
            texts, numbers, kinds = texts[1:], numbers[1:], kinds[1:]
        elif n and not (numbers[0] or block):
            record = texts[0].as_py()
            if names is not None and header(record) != names:
                raise ValueError(f"{file} has other columns: {record[:200]}")
            kinds = pa.concat_arrays([pa.array(["head"]), kinds[1:]])
        n = len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(file, pa.string()), n), pa.repeat(pa.scalar(block, pa.int64()), n), pa.array(numbers, pa.int64()),
             kinds, texts.cast(pa.string())],
            names=_names(_RECORDS),
        )
    yield from leave()


def _joined_fragments(parts: DataFrame) -> DataFrame:
    """The records that cross ranges; a range has at most two fragments of them."""
    begins = F.col("kind") == "open"
    order = Window.partitionBy("file").orderBy("block", begins)
    numbered = parts.withColumn("begins", begins).withColumn("record_no", F.sum(begins.cast("int")).over(order))
    gathered = numbered.groupBy("file", "record_no").agg(
        F.sort_array(F.collect_list(F.struct("block", "begins", "row", "record"))).alias("all")
    )
    first = F.col("all")[0]
    kind = F.when((first["row"] == 0) & (first["block"] == 0), "head").otherwise("whole")
    text = F.array_join(F.transform("all", lambda part: part["record"]), "\n")
    return gathered.select("file", first["block"].alias("block"), first["row"].alias("row"), kind.alias("kind"), text.alias("record"))


def records(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """file, block, row, kind and text of every record, its header included.

    (file, block, row) is the order of the input. With ``names``, another header stops the job.
    """
    lines = _lines(spark, path)
    left_open = _left_open(lines)

    def found(crossing: bool) -> DataFrame:
        return lines.mapInArrow(functools.partial(_records, left_open=left_open, names=names, crossing=crossing), _RECORDS)

    return found(False).unionByName(_joined_fragments(found(True))) if left_open else found(False)


def header(record: str) -> list[str]:
    """The names in the header of a file."""
    return next(csv.reader([record.lstrip(BYTE_ORDER_MARK)]))


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [_KINDS[column.split()[1]] for column in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_names(schema))
