from __future__ import annotations

import datetime as dt

import pytest

from tallymart.functions.calendar import with_time_features
from tallymart.operators import sales
from tallymart.operators.cleaning import clean_orders
from tallymart.operators.filters import in_date_range
from tallymart.params import Params
from tallymart.plans import batch, catalogue
from tallymart.sources import files
from tallymart.sources.orders import dirty_order_lines, order_lines
from tallymart.sources.schema import ORDER_COLUMNS, ORDER_SCHEMA
from tallymart.sources.staging import clear_staged, shared_folder, stage
from tests.conftest import SF_DIR

P = Params(completed_status="F")


def test_csv_with_byte_order_mark_and_bad_cells(spark, tmp_path):
    row = "O1,2025-01-06 10:00:00,A,p,R,c,web,C1,new,1.50,2,3.00,0.1,2.70,card,F"
    bad = "O2,not a date,A,p,R,c,web,C1,new,abc,,3.00,0.1,2.70,card,F"
    text = "﻿" + ",".join(ORDER_COLUMNS) + f"\n{row}\n{bad}\n"
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    rows = files.read_csv(spark, str(tmp_path / "in.csv"), ORDER_SCHEMA).collect()
    assert rows[0]["order_id"] == "O1" and rows[0]["order_date"] == dt.datetime(2025, 1, 6, 10)
    assert [rows[1][c] for c in ("order_date", "unit_price", "quantity")] == [None] * 3
    assert rows[1]["order_status"] == "F"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    text = (
        'note,order_status,category,unit_price,product\nx,F,"say ""hi""",2.5, padded\ny,F,N/A,NA,b\n'
    )
    (tmp_path / "in.csv").write_text(text, encoding="utf-8")
    frame = files.read_csv(spark, str(tmp_path / "in.csv"))
    assert frame.columns == ["category", "product", "unit_price", "order_status"]
    assert [tuple(r) for r in frame.collect()] == [
        ('say "hi"', " padded", "2.5", "F"), (None, "b", None, "F"),
    ]
    files.write_csv(frame, str(tmp_path / "out"))
    again = files.read_csv(spark, str(tmp_path / "out"))
    assert again.collect() == frame.collect()


def test_staged_tables_can_be_cleared(spark):
    stage(spark.range(3), "three")
    assert clear_staged(spark)
    assert not clear_staged(spark)


def test_date_filters_skip_month_folders(spark, make_orders, tmp_path):
    rows = make_orders(*[{"order_date": dt.datetime(2025, m, 5)} for m in range(1, 13)])
    files.write_orders(clean_orders(rows, P), str(tmp_path / "orders"))
    stored = files.read_orders(spark, str(tmp_path / "orders"))
    kept = in_date_range(stored, "2025-03-01", "2025-05-31")
    assert kept.count() == 3
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_load_splits_completed_orders(spark, make_orders, tmp_path):
    rows = make_orders({}, {"order_status": "open"})
    files.write_csv(with_time_features(rows), str(tmp_path / "csv"))
    orders, completed = files.load_orders(spark, str(tmp_path / "csv"), P)
    assert (orders.count(), completed.count()) == (2, 1)
    assert completed.first()["day_name"] == "Monday"


def test_batch_run_writes_and_returns_everything(spark, tmp_path):
    result = batch.run(spark, dirty_order_lines(spark, SF_DIR), str(tmp_path), P)
    stored = files.read_orders(spark, str(tmp_path / "orders"))
    assert stored.count() == result.orders.count() > 0
    report = spark.read.json(str(tmp_path / "cleaning_report")).first()
    assert report["rows_after"] == stored.count()
    assert {p.name for p in tmp_path.iterdir()} >= {
        "metrics_daily_sales", "metrics_category_contribution", "metrics_customer_orders",
        "metrics_monthly_region",
    }
    assert result.forecast.filter("is_forecast").count() == 90
    assert result.insights.count() == 3
    assert set(result.segments.columns) >= {"customer_id", "cluster", "segment"}


class _Context:
    master = "spark://somewhere:1"

    def getCheckpointDir(self):
        return None


class _Session:
    """The three session members that choose the shared folder."""

    sparkContext = _Context()

    def __init__(self, settings: dict[str, str]):
        self.conf = settings


def test_shared_folder_comes_from_the_session():
    assert shared_folder(_Session({"spark.checkpoint.dir": "s3://bucket/x/"})) == "s3://bucket/x"


def test_local_folder_is_refused_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session({}))


def test_reports_on_a_stored_table_equal_reports_on_the_view(spark, tmp_path):
    view = order_lines(spark, SF_DIR)
    files.write_orders(with_time_features(view), str(tmp_path / "orders"))
    stored = files.read_orders(spark, str(tmp_path / "orders"))
    for report in (catalogue.monthly_mom_yoy, catalogue.channel_month, sales.monthly_sales):
        assert report(stored, params=P).collect() == report(view, params=P).collect()
    yearly = sales.kpi(stored, year=1997, params=P)
    assert yearly.collect() == sales.kpi(view, year=1997, params=P).collect()
    plan = yearly._jdf.queryExecution().executedPlan().toString()
    assert "1997-12" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
