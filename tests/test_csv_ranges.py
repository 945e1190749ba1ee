"""The splittable CSV reader against the reader that gives a file to one task."""

from __future__ import annotations

import csv
import io
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as registry
from tallymart.operators.cleaning import coerce_types, drop_duplicate_orders
from tallymart.params import Params
from tallymart.sources import csv_ranges, files
from tallymart.sources.schema import ORDER_COLUMNS, ORDER_SCHEMA, RAW_TEXT_SCHEMA
from tests.conftest import SF_DIR


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def use(size: int) -> None:
        for name in names:
            spark.conf.set(name, str(size))

    yield use
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def plain_breaks(row) -> tuple:
    """The reader for one task turns all line breaks of a file into one kind."""
    return tuple(v and v.replace("\r\n", "\n") for v in row)


def one_task(spark, path: str) -> list[tuple]:
    rows = spark.read.options(**files.CSV_STYLE, multiLine="true").csv(path)
    return sorted(map(plain_breaks, rows.collect()), key=str)


def many_tasks(spark, path: str, names: list[str]) -> list[tuple]:
    schema = ", ".join(f"{n} string" for n in names)
    found = csv_ranges.records(spark, path, names).filter("kind = 'whole'")
    rows = found.selectExpr(f"from_csv(record, '{schema}', map('escape', '\"')) AS c").select("c.*")
    return sorted(map(plain_breaks, rows.collect()), key=str)


def cells(choose: random.Random, n: int) -> list[list[str]]:
    kinds = [
        lambda: "plain text", lambda: "", lambda: 'say ""no""', lambda: "a, b", lambda: "two\nlines",
        lambda: "\n".join(f"line {i}, of \"many\"" for i in range(choose.randrange(30))),
        lambda: "cr\r\nlf", lambda: '5" pipe', lambda: "日本, é", lambda: " padded ",
    ]
    return [[f"id{i}", *(choose.choice(kinds)() for _ in range(3))] for i in range(n)]


@pytest.mark.parametrize("size", [150, 3000, 1 << 27])
def test_many_tasks_read_what_one_task_reads(spark, tmp_path, small_ranges, size):
    choose = random.Random(size)
    names = ["a", "b", "c", "d"]
    for part in range(3):
        with open(tmp_path / f"part-{part}.csv", "w", encoding="utf-8", newline="") as out:
            writer = csv.writer(out, lineterminator=choose.choice(["\n", "\r\n"]))
            writer.writerows([names, *cells(choose, 25)])
    small_ranges(size)
    found = many_tasks(spark, str(tmp_path), names)
    assert found == one_task(spark, str(tmp_path)) and len(found) == 75
    lines = csv_ranges.records(spark, str(tmp_path))
    assert (lines.rdd.getNumPartitions() > 20) == (size == 150)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    """A cell longer than several ranges, quotes inside plain cells, blank lines, no end of the file."""
    long = "\n".join('text, with ""quotes""' for _ in range(200)).replace('""', '"')
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([["a", "b"], ["1", "x"], ["2", long], ["3", "two\nlines"]])
    body = text.getvalue() + '\n   \n4,5" pipe\n"5","open\nto the end'
    (tmp_path / "in.csv").write_text(body, encoding="utf-8")
    small_ranges(100)
    rows = many_tasks(spark, str(tmp_path / "in.csv"), ["a", "b"])
    assert rows[:4] == [("1", "x"), ("2", long), ("3", "two\nlines"), ("4", '5" pipe')]
    assert rows[4][0] == "5"
    blocks = {r["block"] for r in csv_ranges.records(spark, str(tmp_path / "in.csv")).collect()}
    assert 0 in blocks and len(csv_ranges._left_open(csv_ranges._lines(spark, str(tmp_path / "in.csv")))) == 1


def test_another_header_stops_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,region\n1,x\n")
    (tmp_path / "b.csv").write_text("region,order_id\n1,x\n")
    with pytest.raises(Exception, match="other columns"):
        files.read_csv(spark, str(tmp_path)).collect()


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.text(alphabet='a",\n ', max_size=6), min_size=2, max_size=3), max_size=5))
def test_state_after_each_line(table):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(table)
    inside, records = False, 0
    for line in text.getvalue().split("\n")[:-1]:
        inside = csv_ranges.ends_inside(line, inside)
        records += not inside
    assert records == len(table) and not inside


def test_first_copy_as_the_files_have_them(spark, tmp_path, small_ranges):
    """The later date stands in the first file, and in an earlier range of it."""
    for name, rows in {
        "a.csv": [("O1", "2025-03-01"), *((f"X{i}", "2025-01-01") for i in range(300)), ("O2", "2025-02-02"), ("O1", "2025-01-01")],
        "b.csv": [("O2", "2025-01-01"), ("O1", "2024-01-01"), ("O3", "2025-05-05"), ("O3", "2025-04-04")],
    }.items():
        lines = "".join(f"{i},{d}\n" for i, d in rows)
        (tmp_path / name).write_text(f"order_id,order_date\n{lines}")
    small_ranges(500)
    raw = coerce_types(files.read_csv(spark, str(tmp_path), RAW_TEXT_SCHEMA, ordered=True))
    kept = drop_duplicate_orders(raw, Params(duplicate_order=files.INPUT_ORDER).duplicate_order)
    dates = {r["order_id"]: str(r["order_date"].date()) for r in kept.filter("order_id like 'O%'").collect()}
    assert dates == {"O1": "2025-03-01", "O2": "2025-02-02", "O3": "2025-05-05"}
    assert kept.count() == 303


def test_parquet_rows_have_an_input_order(spark, tmp_path):
    for k, values in enumerate(([5, 3, 9], [1, 2])):
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.parquet(str(tmp_path / f"t/k={k}"))
    rows = files.with_input_order(spark.read.parquet(str(tmp_path / "t"))).orderBy(*files.INPUT_ORDER)
    assert [r["v"] for r in rows.collect()] == [5, 3, 9, 1, 2]


def test_typed_cells_are_those_of_the_plain_reader(spark, tmp_path, small_ranges):
    row = "O{},2025-01-06 10:00:00,A,p,R,c,web,C1,new,1.50,2,3.00,0.1,2.70,card,F\n"
    bad = "O{},no date,A,p,R,c,web,C1,new,abc,,3.00,0.1,2.70\n"
    text = "﻿" + ",".join(ORDER_COLUMNS) + "\n" + "".join((bad if i % 3 == 0 else row).format(i) for i in range(50))
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    small_ranges(400)
    path = str(tmp_path / "in.csv")
    split = files.read_csv(spark, path, ORDER_SCHEMA)
    plain = files.read_csv(spark, path, ORDER_SCHEMA, line_breaks=False)
    assert split.schema == plain.schema
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect())) and split.count() == 50


def batched(rows: list[tuple], cuts: set[int]):
    edges = [0, *sorted(c for c in cuts if c < len(rows)), len(rows)]
    for a, b in zip(edges, edges[1:]):
        file, block, value = zip(*rows[a:b]) if a < b else ((), (), ())
        columns = [pa.array(file, pa.string()), pa.array(block, pa.int64()), pa.array(value, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "value"])


LINES = st.lists(st.text(alphabet='a",\r \u3000é', max_size=8), min_size=1, max_size=12)


@settings(deadline=None, max_examples=300)
@given(LINES, st.sets(st.integers(1, 11)), st.sets(st.integers(1, 11)))
def test_lines_of_a_batch_at_once_as_one_by_one(lines, ranges, cuts):
    """The states, the maps of the ranges, and all records and fragments, with ranges and batches cut anywhere."""
    for maps, inside in zip(csv_ranges._line_maps(pa.array(lines)), (False, True)):
        assert maps.tolist() == [csv_ranges.ends_inside(line, inside) for line in lines]
    starts = [0, *sorted(c for c in ranges if c < len(lines))]
    block = [max(s for s in starts if s <= i) for i in range(len(lines))]
    rows = [("f", b, line) for b, line in zip(block, lines)]
    inside, parts, number, wanted, left = False, [], {}, [], []
    for i, (_, b, line) in enumerate(rows):
        if not parts:
            begun = inside
        parts.append(line)
        inside = csv_ranges.ends_inside(line, inside)
        last = i + 1 == len(rows) or block[i + 1] != b
        if not inside and not begun and len(parts) == 1 and not line.strip():
            parts = []
        elif not inside or last:
            kind = ("on" if begun else "open") if inside else "end" if begun else "head" if not (b or number.get(b)) else "whole"
            record = "\n".join(parts)
            wanted.append(("f", b, number.get(b, 0), kind, record if inside else record.removesuffix("\r")))
            number[b], parts = number.get(b, 0) + 1, []
        if inside and last:
            left.append((b, min((s for s in starts if s > b), default=csv_ranges._END)))
    found = {
        crossing: [tuple(r.values()) for out in csv_ranges._records(batched(rows, cuts), {"f": left}, None, crossing) for r in out.to_pylist()]
        for crossing in (False, True)
    }
    fragments = ("open", "on", "end")
    assert found[False] == [r for r in wanted if r[3] not in fragments]
    assert found[True] == [r for r in wanted if r[3] in fragments]
    for out in csv_ranges._range_maps(batched(rows, cuts)):
        for row in out.to_pylist():
            own = [line for b, line in zip(block, lines) if b == row["block"]]
            ends = []
            for state in (False, True):
                for line in own:
                    state = csv_ranges.ends_inside(line, state)
                ends.append(state)
            assert ends == [row["from_outside"], row["from_inside"]]


def test_all_tasks_write_the_files_with_breaks(spark, monkeypatch):
    seen = []
    real = files.write_csv
    monkeypatch.setattr(files, "write_csv", lambda df, path: seen.append(df) or real(df, path))
    registry.queries()["scan_csv_breaks"](spark, SF_DIR)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 1," not in plan and f"Repartition {spark.sparkContext.defaultParallelism}, false" in plan


def test_compressed_parts_keep_the_order_of_the_input(spark, make_orders, tmp_path):
    rows = make_orders(*({"order_id": f"O{i % 7}", "quantity": i, "product": 'a\n"b", c'} for i in range(50)))
    path = str(tmp_path / "late.gz")
    files.write_csv(rows.coalesce(1), path)
    assert all(p.name.endswith(".csv.gz") for p in (tmp_path / "late.gz").glob("part-*"))
    raw = coerce_types(files.read_csv(spark, path, ordered=True))
    kept = drop_duplicate_orders(raw, files.INPUT_ORDER).collect()
    assert sorted((r["order_id"], r["quantity"], r["product"]) for r in kept) == [(f"O{i}", i, 'a\n"b", c') for i in range(7)]
