"""The staged cube against each report on the orders themselves."""

from __future__ import annotations

import datetime as dt

import pytest

from tallymart.operators import customers, dashboard, sales, trends
from tallymart.operators.filters import filter_orders
from tallymart.params import Params
from tallymart.sources.orders import order_lines
from tallymart.sources.staging import stage
from tests.conftest import SF_DIR

P = Params(completed_status="F")
PLAIN = {
    "kpi": sales.kpi, "trend": trends.trend_ma7, "weekday": sales.weekday_average, "category": sales.category_total,
    "region": sales.region_total, "repurchase": customers.repurchase_by_type, "category_trend": sales.category_month,
}


def assert_same(rows, found) -> None:
    assert set(found) == set(PLAIN)
    for name, report in PLAIN.items():
        wanted = report(rows, params=P)
        assert found[name].columns == wanted.columns, name
        assert [tuple(r) for r in found[name].collect()] == [tuple(r) for r in wanted.collect()], name


@pytest.mark.parametrize("slice_", [{}, {"start": "1996-01-01", "end": "1998-12-31", "region": "EUROPE"}, {"category": "none"}])
def test_tables_of_the_cube_are_those_of_the_orders(spark, slice_):
    lines = order_lines(spark, SF_DIR)
    assert_same(filter_orders(lines, **slice_), dashboard.dashboard_datasets(lines, **slice_, params=P))


def test_missing_cells(make_orders):
    rows = make_orders(
        {"order_date": None}, {"category": None}, {"region": None, "final_amount": None}, {"customer_id": None},
        {"customer_type": None}, {"customer_type": "old"}, {"order_id": None}, {"order_status": "open"},
        {"order_date": dt.datetime(2025, 1, 6, 23, 59)}, {"order_date": dt.datetime(2025, 2, 3), "category": "B"},
    )
    assert_same(rows, dashboard.dashboard_datasets(rows, params=P))


def test_tables_read_one_scan_of_the_orders(spark, tmp_path):
    order_lines(spark, SF_DIR).write.parquet(str(tmp_path / "orders"))
    cube = dashboard.sales_cube(spark.read.parquet(str(tmp_path / "orders")), P)
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_sum" in plan
    tables = dashboard.dashboard_tables(stage(cube, "cube"))
    for table in tables.values():
        assert str(tmp_path) not in table._jdf.queryExecution().executedPlan().toString()
