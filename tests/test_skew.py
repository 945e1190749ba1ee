"""A third of all rows in one order id, customer, category, day and price."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymart.operators import cleaning, customers, ranks, rfm, sales
from tallymart.params import Params
from tallymart.plans import catalogue
from tallymart.sources.schema import ORDER_SCHEMA

P = Params(completed_status="F", as_of=dt.date(2025, 6, 1))
N = 6000


@pytest.fixture(scope="module")
def hot(spark):
    i, is_hot = F.col("id"), F.col("id") % 3 == 0
    text = {
        "order_id": F.concat(F.lit("O"), F.when(i % 30 == 0, F.lit(0)).otherwise(i)),
        "category": F.concat(F.lit("K"), F.when(is_hot, F.lit(0)).otherwise(i % 7)),
        "customer_id": F.concat(F.lit("C"), F.when(is_hot, F.lit(0)).otherwise(i % 400)),
        "customer_type": F.lit("t"),
        "order_status": F.lit("F"),
    }
    price = F.when(is_hot, F.lit(5.0)).otherwise((i % 53 + 1) * 1.25)
    day = F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
        F.when(is_hot, F.lit(0)).otherwise(i % 100).cast("int")
    )
    frame = spark.range(N).select(
        *[
            text.get(f.name, {"unit_price": price, "final_amount": price, "quantity": F.lit(1),
                              "order_date": day}.get(f.name, F.lit(0 if f.name in (
                                  "discount_rate", "total_amount") else "x")))
            .cast(f.dataType)
            .alias(f.name)
            for f in ORDER_SCHEMA
        ]
    )
    return frame.repartition(6).cache()


@pytest.fixture(scope="module")
def frame(hot):
    return hot.toPandas().astype({"final_amount": float, "unit_price": float})


def test_hot_groups_are_aggregated_whole(hot, frame):
    row = sales.kpi(hot, params=P).first()
    counts = frame.groupby("customer_id")["order_id"].count()
    assert row["total_orders"] == N and row["total_customers"] == len(counts)
    assert row["total_revenue"] == pytest.approx(frame["final_amount"].sum())
    assert row["repurchase_rate"] == round((counts > 1).mean() * 100, 1)
    table = {r["category"]: r for r in sales.category_contribution(hot, P).collect()}
    expected = frame.groupby("category").agg(n=("order_id", "count"), c=("customer_id", "nunique"))
    assert {k: (r["orders"], r["customers"]) for k, r in table.items()} == {
        k: (r.n, r.c) for k, r in expected.iterrows()
    }
    spent = {r["customer_id"]: r["order_count"] for r in customers.customer_orders(hot, P).collect()}
    assert spent == counts.to_dict()


def test_hot_order_id_and_category_are_cleaned_whole(hot, frame):
    params = Params(completed_status="F")
    cleaned = cleaning.clean_orders(hot, params).toPandas()
    assert sorted(cleaned["order_id"]) == sorted(frame["order_id"].unique())
    unique = frame.sort_values(["order_date", "category"]).drop_duplicates("order_id")
    limits = unique.groupby("category")["unit_price"].quantile([0.25, 0.75]).unstack()
    upper = limits[0.75] + 3 * (limits[0.75] - limits[0.25])
    expected = unique.set_index("order_id")
    expected = expected["unit_price"].clip(upper=expected["category"].map(upper))
    got = cleaned.set_index("order_id")["unit_price"]
    pd.testing.assert_series_equal(
        got.sort_index(), expected.sort_index(), check_names=False, check_dtype=False
    )


@pytest.mark.parametrize("sorted_values", [1, 3])
def test_hot_customer_scores_agree_however_little_is_sorted(hot, sorted_values, monkeypatch):
    usual = [sorted(query(hot, P).collect()) for query in (rfm.rfm_scores, catalogue.rfm_top)]
    monkeypatch.setattr(ranks, "SORTED_VALUES", sorted_values)
    assert usual == [sorted(query(hot, P).collect()) for query in (rfm.rfm_scores, catalogue.rfm_top)]
