from __future__ import annotations

import datetime as dt

import pytest

from tallymart.operators import customers, filters, insights, sales, trends
from tallymart.params import Params
from tallymart.plans import catalogue
from tallymart.sources.orders import order_lines
from tests.conftest import SF_DIR

P = Params(completed_status="F")


def day(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


def test_end_date_leaves_out_later_that_day(make_orders):
    rows = make_orders(
        {"order_date": day(2025, 3, 31)}, {"order_date": day(2025, 3, 31, 10)},
        {"order_date": day(2025, 1, 1)}, {"order_date": day(2024, 12, 31, 23)},
    )
    kept = filters.filter_orders(rows, "2025-01-01", "2025-03-31")
    assert {r["order_id"] for r in kept.collect()} == {"O0", "O2"}


def test_absent_filters_keep_everything(make_orders):
    rows = make_orders({"category": None}, {"category": "B", "region": None})
    assert filters.filter_orders(rows, None, "", "all", "all", 0).count() == 2


def test_null_keys_are_dropped_from_sales_and_kept_in_the_catalogue(make_orders):
    rows = make_orders({"region": None}, {"region": "R"}, {"payment_method": None})
    assert [r["region"] for r in sales.region_total(rows, P).collect()] == ["R"]
    assert {r["region"] for r in catalogue.region_month_rank(rows, P).collect()} == {None, "R"}
    assert None in {r["payment_method"] for r in catalogue.payment_mix(rows, P).collect()}


def test_kpi_counts_rows_without_a_customer(make_orders):
    rows = make_orders({"customer_id": None}, {}, {}, {"customer_id": "C2"},
                       {"order_status": "open"})
    row = sales.kpi(rows, params=P).first()
    assert (row["total_orders"], row["total_customers"]) == (4, 2)
    assert (row["total_revenue"], row["repurchase_rate"]) == (40.0, 50.0)


def test_kpi_of_nothing(make_orders):
    row = sales.kpi(make_orders({}), category="none", params=P).first()
    assert (row["total_revenue"], row["total_orders"], row["repurchase_rate"]) == (0.0, 0, 0.0)
    assert row["avg_order_value"] is None


def test_growth_over_missing_and_zero_months(make_orders):
    rows = make_orders(
        {"order_date": day(2024, 1, 5), "final_amount": 0},
        {"order_date": day(2024, 2, 5), "final_amount": 10},
        {"order_date": day(2024, 4, 5), "final_amount": 15},
        {"order_date": day(2025, 4, 5), "final_amount": 30},
    )
    by_row = [r["mom_growth"] for r in sales.monthly_sales(rows, params=P).collect()]
    assert by_row == [None, None, 50.0, 100.0]
    table = catalogue.monthly_mom_yoy(rows, P).collect()
    assert [r["mom_growth_pct"] for r in table] == [None, None, None, None]
    assert [r["yoy_growth_pct"] for r in table] == [None, None, None, 100.0]


def test_declines_need_not_be_consecutive(make_orders):
    amounts = [100, 90, 95, 80]
    rows = make_orders(*[
        {"order_date": day(2025, m, 1), "final_amount": a} for m, a in enumerate(amounts, start=1)
    ])
    table = catalogue.decline_alert(rows, P).collect()
    assert [(r["year_month"], r["consecutive_declines"]) for r in table] == [("2025-04", 2)]


def test_moving_averages_wait_or_start_at_once(make_orders):
    rows = make_orders(*[
        {"order_date": day(2025, 1, d), "final_amount": d} for d in range(1, 9)
    ])
    waiting = [r["ma7"] for r in trends.moving_average(rows, P).collect()]
    assert waiting == [None] * 6 + [4.0, 5.0]
    eager = [r["ma7"] for r in trends.trend_ma7(rows, P).collect()]
    assert eager == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0]


def test_weekend_uplift_and_insight_text(make_orders):
    rows = make_orders(
        {"order_date": day(2025, 1, 4), "final_amount": 30},  # Saturday
        {"order_date": day(2025, 1, 6), "final_amount": 10},
        {"order_date": day(2025, 1, 7), "final_amount": 30},
    )
    assert sales.weekend_uplift(rows, P).first()["uplift_pct"] == 50.0
    table = insights.insights(rows, params=P).collect()
    assert len(table) == 3 and "50.0%" in table[0]["detail"] and "90" in table[2]["detail"]
    assert len(insights.insights(rows, insights.SERVICE_ROWS, params=P).collect()) == 2


def test_weekday_average_spans_elapsed_weeks(make_orders):
    rows = make_orders(
        {"order_date": day(2025, 1, 6, 12), "final_amount": 10},
        {"order_date": day(2025, 1, 20, 12), "final_amount": 30},
    )
    row = sales.weekday_average(rows, P).first()
    assert (row["day_of_week"], row["avg_revenue"]) == (0, 20.0)


def test_repurchase_by_type(make_orders):
    rows = make_orders({}, {}, {"customer_id": "C2"}, {"customer_id": "C3", "customer_type": None})
    assert [tuple(r) for r in customers.repurchase_by_type(rows, P).collect()] == [
        ("new", 2, 1, 50.0)
    ]


def test_top_customers_break_ties_the_same_way_each_time(make_orders):
    rows = make_orders(*[{"customer_id": f"C{i}"} for i in range(12)])
    params = Params(completed_status="F", top_n=5, as_of=dt.date(2025, 2, 1))
    first = catalogue.rfm_top(rows, params).collect()
    assert first == catalogue.rfm_top(rows.repartition(5), params).collect()
    assert len(first) == 5 and first[0]["recency_days"] == 26


def test_unknown_export_kind(make_orders):
    with pytest.raises(ValueError):
        sales.export_summary(make_orders({}), "xlsx", P)


def test_dimensions_without_wanted_columns_are_not_joined(spark):
    df = sales.channel_sales(
        order_lines(spark, SF_DIR, ["order_id", "channel", "order_status", "final_amount"]), P
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "customer.parquet" not in plan and "nation.parquet" not in plan
    assert "EqualTo(o_orderstatus,F)" in plan


def test_no_orphans_so_left_and_inner_joins_agree(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        lines = order_lines(spark, f"/root/testdata/{sf}", ["city", "region", "category",
                                                            "customer_type", "channel"])
        assert lines.dropna().count() == lines.count()
