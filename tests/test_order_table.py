"""The stored order table: keys, required columns, and lookups that skip files."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from tallymart.functions.calendar import with_time_features
from tallymart.sources import files, schema


@pytest.fixture
def table(spark, tmp_path):
    name = f"orders_{uuid.uuid4().hex}"
    schema.create_order_table(spark, name, str(tmp_path / "orders"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def scanned_rows(df) -> tuple[int, int]:
    """Rows that the scan handed over, and rows found."""
    found = len(df.collect())
    node = df._jdf.queryExecution().executedPlan()
    while node.children().nonEmpty():
        node = node.children().head()
    return node.metrics().apply("numOutputRows").value(), found


def test_a_lookup_reads_one_file(spark, table, make_orders):
    rows = make_orders(*[
        {"order_id": f"K{(i * 7919) % 4000:05}", "customer_id": f"C{(i * 104729) % 1999:05}",
         "order_date": dt.datetime(2025, 1 + i % 4, 1 + i % 28)} for i in range(4000)
    ])
    files.insert_orders(with_time_features(rows), table)
    assert spark.table(table).count() == 4000
    scanned, found = scanned_rows(spark.table(table).filter("order_id = 'K01234'"))
    assert found == 1 and scanned <= 1000  # one of four files
    scanned, found = scanned_rows(spark.table(table).filter("order_id = 'K01234x'"))
    assert (scanned, found) == (0, 0)  # between the ends of every file; only the filter can tell
    scanned, found = scanned_rows(spark.table(table).filter("customer_id = 'C00077x'"))
    assert (scanned, found) == (0, 0)


@pytest.mark.parametrize("column", schema.REQUIRED)
def test_required_cells_are_required(table, make_orders, column):
    with pytest.raises(Exception, match=f"needs {column}"):
        files.insert_orders(with_time_features(make_orders({column: None})), table)


def test_only_new_keys_go_in(spark, table, make_orders):
    days = [dt.datetime(2025, 1, d) for d in (1, 2, 3)]
    first = make_orders({"order_id": "A", "order_date": days[1]}, {"order_id": "A", "order_date": days[0]}, {"order_id": "B"})
    rejected = files.insert_new_orders(with_time_features(first), table)
    assert [tuple(r) for r in rejected.collect()] == [("A", days[0], "repeated")]
    second = make_orders(
        {"order_id": "A"}, {"order_id": "C"}, {"order_id": "C"}, {"order_id": None}, {"order_id": "D", "order_date": None}
    )
    rejected = files.insert_new_orders(with_time_features(second), table)
    reasons = sorted((r["order_id"] or "", r["reason"]) for r in rejected.collect())
    assert reasons == [("", "missing"), ("A", "exists"), ("C", "repeated"), ("D", "missing")]
    stored = {r["order_id"]: r["order_date"] for r in spark.table(table).collect()}
    assert set(stored) == {"A", "B", "C"} and stored["A"] == days[0]


def test_the_table_keeps_its_statement(spark, table):
    text = spark.sql(f"SHOW CREATE TABLE {table}").first()[0]
    assert "bloom.filter.enabled#order_id" in text and "PARTITIONED BY (year_month)" in text
