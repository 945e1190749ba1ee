from __future__ import annotations

import datetime as dt
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallymart.functions.calendar import elapsed_days, with_time_features
from tallymart.operators import cleaning
from tallymart.params import Params
from tallymart.sources.orders import dirty_order_lines
from tallymart.sources.schema import RAW_TEXT_SCHEMA
from tests.conftest import SF_DIR

P = Params(completed_status="F")


def _by_id(df):
    return {r["order_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def cleaned(spark):
    return cleaning.clean_orders(dirty_order_lines(spark, SF_DIR), P).cache()


def test_cells_that_do_not_parse_become_null(make_orders):
    text = {
        "order_date": "2025-01-06 10:00:00", "unit_price": "1.50", "quantity": "2",
        "total_amount": "3", "discount_rate": "0.1", "final_amount": "2.7",
    }
    raw = make_orders(
        text,
        {**text, "order_date": "bad", "unit_price": "abc", "quantity": "", "category": "nan"},
        {**text, "unit_price": "nan", "quantity": "1.5d", "discount_rate": None},
        schema=RAW_TEXT_SCHEMA,
    )
    good, bad, odd = (_by_id(cleaning.coerce_types(raw))[k] for k in ("O0", "O1", "O2"))
    assert good["order_date"] == dt.datetime(2025, 1, 6, 10) and good["unit_price"] == 1.5
    assert [bad[c] for c in ("order_date", "unit_price", "quantity", "category")] == [None] * 4
    assert [odd[c] for c in ("unit_price", "quantity", "discount_rate")] == [None] * 3


def test_duplicates_keep_the_first_in_a_total_order(make_orders):
    rows = make_orders(
        {"order_id": "X", "order_date": dt.datetime(2025, 1, 2), "category": "late"},
        {"order_id": "X", "order_date": dt.datetime(2025, 1, 1), "category": "b"},
        {"order_id": "X", "order_date": dt.datetime(2025, 1, 1), "category": "a"},
        {"order_id": None, "category": "n1"},
        {"order_id": None, "category": "n2"},
    )
    kept = _by_id(cleaning.drop_duplicate_orders(rows))
    assert {k: r["category"] for k, r in kept.items()} == {"X": "a", None: "n1"}


def test_duplicates_can_follow_a_load_sequence(make_orders):
    rows = make_orders({"order_id": "X", "category": "a"}, {"order_id": "X", "category": "b"})
    loaded = rows.withColumn("seq", F.when(F.col("category") == "b", 1).otherwise(2))
    kept = cleaning.cap_outliers(loaded, replace(P, duplicate_order=("seq",))).collect()
    assert [r["category"] for r in kept] == ["b"] and "seq" not in kept[0].asDict()


def test_duplicates_are_cut_down_before_the_shuffle(spark):
    df = cleaning.drop_duplicate_orders(dirty_order_lines(spark, SF_DIR))
    plan = df._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning(order_id"):]
    assert "partial_min" in before_shuffle


def test_prices_are_imputed_from_the_category_then_from_all(make_orders):
    raw = make_orders(
        *[{"category": "A", "unit_price": p} for p in (1, 2, 3, 10)],
        {"category": "A", "unit_price": None},
        {"category": "empty", "unit_price": None},
        {"category": None, "unit_price": None},
        {"category": None, "unit_price": 100},
    )
    prices = {k: r["unit_price"] for k, r in _by_id(cleaning.impute_orders(raw, P)).items()}
    assert prices["O4"] == 2.5  # median of 1, 2, 3, 10
    assert prices["O5"] == prices["O6"] == 3.0  # median of 1, 2, 3, 10, 100


def test_labels_and_quantities_are_filled(make_orders):
    raw = make_orders({"category": None, "region": None, "payment_method": None, "city": None,
                       "quantity": None, "product": None})
    row = cleaning.impute_orders(raw, P).first()
    labels = [row[c] for c in ("category", "region", "payment_method", "city")]
    assert labels == [P.unknown_label] * 4
    assert row["quantity"] == P.default_quantity and row["product"] is None


@pytest.mark.parametrize("worst, expected", [("0.9", 0.7), ("1.5", 0.5), ("-0.1", 0.5)])
def test_one_bad_discount_limits_all(make_orders, worst, expected):
    raw = make_orders({"discount_rate": "0.7"}, {"discount_rate": worst}, {"discount_rate": None})
    rows = _by_id(cleaning.cap_outliers(raw, P))
    assert rows["O0"]["discount_rate"] == expected
    assert rows["O2"]["discount_rate"] is None


def test_price_limit_uses_imputed_prices_and_the_unknown_category(make_orders):
    raw = make_orders(
        *[{"category": None, "unit_price": p} for p in (10, 10, 10, 20, 1000)],
        {"category": P.unknown_label, "unit_price": 10},
    )
    rows = _by_id(cleaning.cap_outliers(raw, P))
    # Prices 10 10 10 10 20 1000: quartiles 10 and 17.5, so the limit is 40.
    assert rows["O4"]["unit_price"] == 40.0
    assert float(rows["O4"]["total_amount"]) == 40.0


def test_invariants_on_the_dirty_lines(spark, cleaned):
    rows = cleaned.agg(
        F.min("quantity").alias("q"), F.min("discount_rate").alias("d0"),
        F.max("discount_rate").alias("d1"), F.count_distinct("order_id").alias("ids"),
        F.count(F.lit(1)).alias("rows"),
        F.sum(sum(F.col(c).isNull().cast("int") for c in cleaned.columns)).alias("nulls"),
    ).first()
    assert rows["q"] >= 0 and rows["d0"] >= 0 and rows["d1"] <= 0.5
    assert rows["ids"] == rows["rows"] and rows["nulls"] == 0


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_any_join_of_the_prices_gives_the_same_rows(spark, cleaned, limit):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        other = cleaning.clean_orders(dirty_order_lines(spark, SF_DIR), P)
        assert other.exceptAll(cleaned).isEmpty() and cleaned.exceptAll(other).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_report_counts(make_orders):
    raw = make_orders(
        {"order_id": "X"}, {"order_id": "X"},
        {"quantity": -2}, {"discount_rate": "1.5"}, {"unit_price": None, "quantity": None},
        {"unit_price": 1000}, {"customer_id": "C2"},
    )
    row = cleaning.clean_report(raw, P).first()
    assert (row["rows_before"], row["rows_after"], row["duplicates_removed"]) == (7, 6, 1)
    assert row["nulls"]["before"] == 2 and row["nulls"]["after"] == 0
    assert row["outliers_handled"] == 3
    assert row["repurchase_rate"] == 50.0


def test_week_numbers_agree_with_the_calendar(spark):
    start = dt.date(2019, 12, 25)
    days = [start + dt.timedelta(days=i) for i in range(2200)]
    frame = spark.createDataFrame([(d,) for d in days], "order_date date")
    for row in with_time_features(frame).collect():
        day = row["order_date"]
        assert row["year_week"] == day.strftime("%Y-W%U")
        assert (row["week"], row["day_of_week"]) == (day.isocalendar()[1], day.weekday())
        assert row["is_weekend"] == int(day.weekday() >= 5)
        assert row["quarter"] == math.ceil(day.month / 3)


def test_elapsed_days_are_full_days(spark):
    frame = spark.createDataFrame(
        [(dt.datetime(2025, 3, 29, 23, 59), dt.datetime(2025, 3, 30, 0, 0)),
         (dt.datetime(2025, 3, 29, 12, 0), dt.datetime(2025, 3, 31, 12, 0))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    days = [r[0] for r in frame.select(elapsed_days(F.col("a"), F.col("b"))).collect()]
    assert days == [0, 2]
