"""Cells and days that a clean table never shows."""

from __future__ import annotations

import datetime as dt

import pytest

from tallymart.operators import cleaning, customers, forecast, sales, trends
from tallymart.params import Params
from tallymart.plans import batch
from tallymart.sources import files
from tallymart.sources.orders import order_lines
from tallymart.sources.schema import CLEAN_SCHEMA, RAW_TEXT_SCHEMA
from tallymart.sources.staging import scratch_path, stage, staging
from tests.conftest import SF_DIR

P = Params(completed_status="F")
NAMES = [f.name for f in RAW_TEXT_SCHEMA]


def raw(spark, *rows: dict):
    base = dict.fromkeys(NAMES, "x") | {
        "order_date": "2025-01-06 10:00:00", "unit_price": "2.5", "quantity": "2",
        "total_amount": "5", "discount_rate": "0.1", "final_amount": "4.5", "order_status": "F",
    }
    filled = [base | {"order_id": f"O{i}"} | row for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in filled], RAW_TEXT_SCHEMA)


@pytest.mark.parametrize(("cell", "moment"), [
    ("2025/01/06 10:00", dt.datetime(2025, 1, 6, 10)), ("01/06/2025", dt.datetime(2025, 1, 6)),
    ("20250106", dt.datetime(2025, 1, 6)), ("2025/1/6", dt.datetime(2025, 1, 6)),
    ("2025-01-06T10:00:00", dt.datetime(2025, 1, 6, 10)), ("2025-01-06", dt.datetime(2025, 1, 6)),
    ("2025-01-06 10:00:00.5", dt.datetime(2025, 1, 6, 10, 0, 0, 500_000)),
    ("13/45/2025", None), ("bad", None), ("", None), (None, None),
])
def test_dates_of_many_forms(spark, cell, moment):
    assert cleaning.coerce_types(raw(spark, {"order_date": cell})).first()["order_date"] == moment


def test_no_cell_stops_the_cleaning(spark):
    rows = [
        {"quantity": q, "unit_price": p, "discount_rate": d}
        for q in ("3000000000", "-9223372036854775808", "1e300", "-2")
        for p, d in (("1e15", "0"), ("1e308", "7"), ("2", "-1e300"))
    ]
    found = cleaning.clean_orders(raw(spark, *rows), P).collect()
    assert len(found) == len(rows)
    first = next(r for r in found if r["order_id"] == "O0")
    assert first["quantity"] == 3_000_000_000
    assert cleaning.clean_report(raw(spark, *rows), P).first()["rows_after"] == len(rows)


def test_csv_keeps_line_breaks_quotes_and_fractions(spark, tmp_path):
    cells = ["a\nb", 'say "x", then\r\ny', " padded ", "plain"]
    table = raw(spark, *({"product": c, "order_date": f"2025-01-0{i + 1} 10:00:00.25"} for i, c in enumerate(cells)))
    typed = cleaning.coerce_types(table)
    files.write_csv(typed, str(tmp_path / "t"))
    again = files.read_csv(spark, str(tmp_path / "t"), CLEAN_SCHEMA).orderBy("order_id").collect()
    assert [r["product"] for r in again] == cells
    assert [r["order_date"] for r in again] == [dt.datetime(2025, 1, i + 1, 10, 0, 0, 250_000) for i in range(4)]


def test_typed_dates_of_a_plain_file(spark, tmp_path):
    cells = ["2025-01-06", "2025-01-06 10:00", "2025-01-06T10:00:00", "2025/1/6 10:00:00"]
    (tmp_path / "in.csv").write_text("order_id,order_date,order_status\n" + "".join(f"{i},{c},F\n" for i, c in enumerate(cells)))
    orders, done = files.load_orders(spark, str(tmp_path / "in.csv"), P)
    assert [r["order_date"].hour for r in orders.orderBy("order_id").collect()] == [0, 10, 10, 10]
    assert done.count() == 4


def test_a_day_of_null_amounts_is_a_day_of_zero(make_orders):
    rows = [
        {"order_date": dt.datetime(2025, 1, 1) + dt.timedelta(days=i), "final_amount": None if i == 20 else 10 + i % 7}
        for i in range(40)
    ]
    table = make_orders(*rows)
    series = {r["ds"]: r["y"] for r in trends.daily_series(table, params=P).collect()}
    assert series[dt.date(2025, 1, 21)] == 0
    found = forecast.sales_forecast(table, params=P).collect()
    ahead = [r["predicted"] for r in found if r["is_forecast"]]
    assert len(ahead) == P.forecast_days and None not in ahead and max(ahead) > 0
    assert sum(not r["is_forecast"] for r in found) == 40
    assert forecast.hw_grid(table, params=P).filter("aic is null").isEmpty()
    assert sales.daily_sales(table, P).filter("revenue is null").isEmpty()
    assert sales.avg_daily_revenue(table, P).first()[0] == pytest.approx(sum(series.values()) / 40)
    spent = customers.customer_orders(make_orders({"customer_id": "Z", "final_amount": None}), P).first()
    assert spent["total_spent"] == 0


def test_a_short_series_has_no_predictions(make_orders):
    found = forecast.sales_forecast(make_orders({}, {}), params=P).filter("is_forecast").collect()
    assert {r["predicted"] for r in found} == {None}


@pytest.mark.parametrize("name", ["kpi_filtered", "daily_sales_range", "dashboard_region"])
def test_dates_reach_the_scan_of_the_orders(spark, name):
    import __spark_entry__ as registry

    plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
    assert filters and all("GreaterThanOrEqual(o_orderdate" in line for line in filters)


def test_pruned_days_lose_no_row(spark):
    whole = order_lines(spark, SF_DIR, ["order_id", "order_date"]).filter(
        "order_date >= '1996-05-01' and order_date < '1996-06-01'"
    )
    pruned = order_lines(spark, SF_DIR, ["order_id", "order_date"], ("1996-05-01", "1996-05-31"))
    assert pruned.exceptAll(whole).isEmpty() and whole.exceptAll(pruned).isEmpty()


def test_staging_ends(spark, make_orders, tmp_path):
    with staging(spark) as folder:
        table = stage(spark.range(5), "five")
        assert table.count() == 5 and scratch_path(spark, "x").startswith(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        assert system.exists(path)
    assert not system.exists(path)
    assert not scratch_path(spark, "x").startswith(folder)
    days = [{"order_date": dt.datetime(2025, 1, 1) + dt.timedelta(days=i % 30), "customer_id": f"C{i % 9}"} for i in range(60)]
    seen = []
    original = batch.staging
    try:
        batch.staging = lambda s: seen.append(original(s)) or seen[-1]
        result = batch.run(spark, make_orders(*days), str(tmp_path / "out"), P)
    finally:
        batch.staging = original
    assert len(seen) == 1
    assert result.forecast.count() == 30 + P.forecast_days and result.segments.count() == 9
    assert result.report.first()["rows_after"] == 60
