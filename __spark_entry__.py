
from __future__ import annotations

import datetime as dt
import importlib
import importlib.util
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles.sql import oracles
from tallymart.functions.calendar import with_time_features
from tallymart.functions.numeric import round_half_up
from tallymart.operators import (
    cleaning, customers, dashboard, filters, forecast, insights, long_series, rfm, sales, trends,
)
from tallymart.params import Params
from tallymart.plans import batch, catalogue
from tallymart.sources import files, orders, schema
from tallymart.sources.staging import scratch_path, shuffles_released, stage, staging


def _is_installed(name: str) -> bool:
    """Whether there is a module or package of that name; what it imports is its own affair."""
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.has_location


# The subpackage may not be part of this installation. A broken one is an error.
_with_llm = _is_installed("tallymart.llm") and _is_installed("corpus_pipeline")
llm = importlib.import_module("tallymart.llm.queries") if _with_llm else None

PARAMS = Params(completed_status="F", as_of=dt.date(2002, 1, 1))
SLICE = {"start": "1996-01-01", "end": "1998-12-31", "category": "all", "region": "EUROPE"}

Query = Callable[[SparkSession, str], DataFrame]

METRICS = ("daily_sales", "category_contribution", "customer_orders", "monthly_region")
DONE = ["order_id", "order_date", "order_status", "final_amount"]


def _over_orders(
    operator: Callable[..., DataFrame], *more: str, days: orders.Days | None = None, **arguments
) -> Query:
    """An operator over the order lines, of which only the named columns are derived.

    ``days`` are those that the operator's own date filter leaves, so that the scan skips others.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = orders.order_lines(spark, sf_dir, [*DONE, *more], days)
        return operator(lines, params=PARAMS, **arguments)

    return query


def _over_dirty(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(orders.dirty_order_lines(spark, sf_dir), params=PARAMS)


def _dashboard(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = orders.order_lines(
            spark, sf_dir, [*DONE, "category", "region", "customer_id", "customer_type"],
            (SLICE["start"], SLICE["end"]),
        )
        return dashboard.dashboard_datasets(lines, **SLICE, params=PARAMS)[name]

    return query


# --- sources and sinks ----------------------------------------------------------------------


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    files.write_csv(orders.raw_text_lines(spark, sf_dir), path)
    return cleaning.coerce_types(files.read_csv(spark, path))


def scan_csv_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose product cells hold a line break, commas and quotes, each read by many tasks.

    There is one for each core, so that all write and every file is long enough for many ranges.
    """
    path = scratch_path(spark, "raw-csv")
    odd = F.concat("product", F.lit('\nsay "'), "city", F.lit('", '), "order_id")
    # The files are written from stored lines, after the shuffles of the joins are gone.
    with staging(spark), shuffles_released(spark):
        lines = stage(orders.raw_text_lines(spark, sf_dir), "lines").withColumn("product", odd)
        files.write_csv(lines.coalesce(spark.sparkContext.defaultParallelism), path)
    return cleaning.coerce_types(files.read_csv(spark, path))


def dedup_input_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold late orders first; of each order the copy that comes first in them stays."""
    path = f"{scratch_path(spark, 'late-first')}.gz"
    late_first = [F.desc_nulls_last(c) for c in ("order_date", *schema.ORDER_COLUMNS)]
    # The ranges are found and dealt from stored lines, after the shuffles of the joins are gone.
    with staging(spark), shuffles_released(spark):
        lines = stage(orders.dirty_order_lines(spark, sf_dir), "lines").repartitionByRange(*late_first)
        files.write_csv(lines.sortWithinPartitions(*late_first), path)
    loaded = cleaning.coerce_types(files.read_csv(spark, path, ordered=True))
    return cleaning.drop_duplicate_orders(loaded, files.INPUT_ORDER).select(*schema.ORDER_COLUMNS)


def write_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clean")
    dirty = orders.dirty_order_lines(spark, sf_dir)
    files.write_orders(cleaning.clean_orders(dirty, PARAMS), path)
    return files.read_orders(spark, path)


def write_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders.order_lines(
        spark, sf_dir, [*DONE, "customer_id", "category", "region", "unit_price"]
    )
    metrics = batch.base_metrics(lines, PARAMS)
    paths = files.write_metrics(metrics, scratch_path(spark, "metrics"))
    amounts = {name: "revenue" for name in metrics} | {"customer_orders": "total_spent"}
    summaries = [
        files.read_csv(spark, paths[name], table.schema).agg(
            F.lit(name).alias("metric"),
            F.count(F.lit(1)).alias("records"),
            F.sum(F.col(amounts[name]).cast("decimal(18,2)")).cast("double").alias("revenue"),
        )
        for name, table in metrics.items()
    ]
    result = summaries[0]
    for summary in summaries[1:]:
        result = result.unionByName(summary)
    return result


def _stored_metric(name: str) -> Query:
    """The rows of one metric table as they come back from its CSV files."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = orders.order_lines(
            spark, sf_dir, [*DONE, "customer_id", "category", "region", "unit_price"]
        )
        table = batch.base_metrics(lines, PARAMS)[name]
        paths = files.write_metrics({name: table}, scratch_path(spark, "metrics"))
        return files.read_csv(spark, paths[name], table.schema)

    return query


def _flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "rows_before",
        "rows_after",
        "duplicates_removed",
        F.col("nulls.before").alias("nulls_before"),
        F.col("nulls.after").alias("nulls_after"),
        "outliers_handled",
        "repurchase_rate",
    )


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = orders.dirty_order_lines(spark, sf_dir)
    return _flat_report(cleaning.clean_report(dirty, PARAMS))


def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = cleaning.clean_report(orders.dirty_order_lines(spark, sf_dir), PARAMS)
    files.write_report(report, path)
    return _flat_report(spark.read.schema(report.schema).json(path))


def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"orders_{uuid.uuid4().hex}"
    schema.create_order_table(spark, table, scratch_path(spark, "order-table"))
    lines = with_time_features(orders.order_lines(spark, sf_dir))
    files.insert_orders(lines, table)
    rows = filters.in_date_range(spark.table(table), "1997-03-15", "1998-02-10")
    return rows.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("records"), F.sum("final_amount").cast("double").alias("revenue")
    )


def insert_new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping loads into a keyed table: rows of it and rejected ones by month."""
    table = f"orders_{uuid.uuid4().hex}"
    schema.create_order_table(spark, table, scratch_path(spark, "keyed-orders"))
    # A load reads the orders of its own days; a day more at its ends has room for any hour.
    early, late = (
        with_time_features(orders.order_lines(spark, sf_dir, days=days)) for days in ((None, "1998-01-02"), ("1996-12-31", None))
    )
    loads = early.filter("order_date < timestamp_ntz '1998-01-01'"), late.filter("order_date >= timestamp_ntz '1997-01-01'")
    rejected = [files.insert_new_orders(load, table) for load in loads]
    reasons = rejected[0].unionByName(rejected[1]).groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month")).agg(
        F.count_if(F.col("reason") == "repeated").alias("repeated"), F.count_if(F.col("reason") == "exists").alias("existing")
    )
    stored = spark.table(table).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("records"), F.sum("final_amount").cast("double").alias("revenue")
    )
    return stored.join(reasons, "year_month", "left").fillna(0, ["repeated", "existing"])


def export_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    files.export_completed(orders.order_lines(spark, sf_dir), path, PARAMS)
    return files.read_csv(spark, path, schema.ORDER_SCHEMA)


def load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    files.write_csv(orders.order_lines(spark, sf_dir), path)
    _, completed = files.load_orders(spark, path, PARAMS, schema.ORDER_SCHEMA)
    return completed


# --- single steps ---------------------------------------------------------------------------


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_time_features(
        orders.order_lines(spark, sf_dir, ["order_id", "order_date", "product"])
    )


def clean_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.coerce_types(orders.raw_text_lines(spark, sf_dir))


def clean_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = orders.dirty_order_lines(spark, sf_dir)
    return cleaning.drop_duplicate_orders(cleaning.coerce_types(dirty))


def impute_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = orders.dirty_order_lines(spark, sf_dir)
    return cleaning.impute_orders(dirty, PARAMS).select("order_id", "category", "unit_price")


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(orders.raw_text_lines(spark, sf_dir), PARAMS)


def text_iqr_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.price_cap_summary(orders.raw_text_lines(spark, sf_dir), PARAMS)


def filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders.order_lines(spark, sf_dir, ["category", "region"])
    return filters.filter_values(lines, "category", "region")


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.date_bounds(orders.order_lines(spark, sf_dir, ["order_date"]))


def forecast_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders.order_lines(spark, sf_dir, DONE)
    return forecast.forecast_total(forecast.sales_forecast(lines, params=PARAMS))


def event_series_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    points = events.select("event_type", F.col("ts").alias("t"), F.col("value").alias("y"))
    found = long_series.grid(points, ["event_type"], PARAMS, block=512)
    return found.withColumn("aic", round_half_up(F.col("aic"), 4))


def sales_forecast_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast by category composed from quarters instead of folded whole."""
    lines = orders.order_lines(spark, sf_dir, [*DONE, "category"])
    days = trends.daily_totals(lines, ("category",), PARAMS)
    points = days.select("category", F.col("date").alias("t"), F.col("total").alias("y"))
    found = long_series.forecast(points, ["category"], PARAMS, block=91)
    return found.withColumn("predicted", round_half_up(F.col("predicted"), 2))


def forecast_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders.order_lines(spark, sf_dir, DONE)
    predicted = forecast.sales_forecast(lines, params=PARAMS)
    return forecast.forecast_overlay(lines, predicted, PARAMS)


def _type_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers grouped by their type in place of a cluster, so that results are determined."""
    lines = orders.order_lines(spark, sf_dir, [*DONE, "customer_id", "customer_type"])
    return rfm.rfm(lines, PARAMS).withColumnRenamed("customer_type", "cluster")


def segment_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.name_segments(rfm.cluster_profile(_type_groups(spark, sf_dir)))


def group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.segment_summary(rfm.customer_segments(_type_groups(spark, sf_dir)))


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.segment_sizes(rfm.customer_segments(_type_groups(spark, sf_dir)))


def _clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders.order_lines(spark, sf_dir, [*DONE, "customer_id", "customer_type"])
    return rfm.cluster_customers(lines, PARAMS)


def entry(spark: SparkSession) -> DataFrame:
    """Headline numbers of the smallest data set."""
    return queries()["kpi"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return _order_queries() | {k: _importable(q) for k, q in (llm.queries() if llm else {}).items()}


def _importable(query: Query) -> Query:
    """Let Python workers of a session started elsewhere find this package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent))
        return query(spark, sf_dir)

    return run


def _order_queries() -> dict[str, Query]:
    who = ["customer_id", "customer_type"]
    return {
        "scan_csv": scan_csv,
        "scan_csv_breaks": scan_csv_breaks,
        "dedup_input_order": dedup_input_order,
        "write_clean": write_clean,
        "write_metrics": write_metrics,
        **{f"stored_{name}": _stored_metric(name) for name in METRICS},
        "write_report": write_report,
        "create_table": create_table,
        "insert_new_orders": insert_new_orders,
        "export_completed": export_completed,
        "export_summary": _over_orders(sales.export_summary, "category"),
        "load_orders": load_orders,
        "clean_types": clean_types,
        "clean_dedup": clean_dedup,
        "null_profile": _over_dirty(cleaning.null_profile),
        "impute_price": impute_price,
        "clean_missing": _over_dirty(cleaning.impute_orders),
        "clean_outliers": _over_dirty(cleaning.cap_outliers),
        "iqr_cap": _over_dirty(cleaning.price_cap_summary),
        "time_features": time_features,
        "clean_report": clean_report,
        "clean_orders": _over_dirty(cleaning.clean_orders),
        "clean_text": clean_text,
        "text_iqr_cap": text_iqr_cap,
        "kpi": _over_orders(sales.kpi, "customer_id"),
        "kpi_filtered": _over_orders(
            sales.kpi, "customer_id", "category", "region",
            category="PROMO", region="ASIA", year=1997, days=("1997-01-01", "1997-12-31"),
        ),
        "daily_sales_range": _over_orders(
            sales.daily_sales_range, start="1996-05-01", end="1997-04-30",
            days=("1996-05-01", "1997-04-30"),
        ),
        "filter_values": filter_values,
        "date_bounds": date_bounds,
        "dashboard_slice": _dashboard("kpi"),
        "dashboard_trend": _dashboard("trend"),
        "dashboard_weekday": _dashboard("weekday"),
        "dashboard_category": _dashboard("category"),
        "dashboard_region": _dashboard("region"),
        "dashboard_repurchase": _dashboard("repurchase"),
        "dashboard_category_trend": _dashboard("category_trend"),
        "daily_sales": _over_orders(sales.daily_sales, "customer_id"),
        "category_contribution": _over_orders(
            sales.category_contribution, "customer_id", "category", "unit_price"
        ),
        "customer_orders": _over_orders(customers.customer_orders, "customer_id"),
        "repurchase_overall": _over_orders(customers.repurchase_overall, "customer_id"),
        "monthly_region": _over_orders(sales.monthly_region, "region"),
        "avg_daily_revenue": _over_orders(sales.avg_daily_revenue),
        "category_sales": _over_orders(
            sales.category_sales, "category", "region", region="AMERICA"
        ),
        "region_sales": _over_orders(sales.region_sales, "category", "region", category="LARGE"),
        "monthly_sales": _over_orders(sales.monthly_sales, "customer_id"),
        "repurchase_by_type": _over_orders(customers.repurchase_by_type, *who),
        "weekend_uplift": _over_orders(sales.weekend_uplift),
        "weekday_average": _over_orders(sales.weekday_average),
        "category_total": _over_orders(sales.category_total, "category"),
        "category_month": _over_orders(sales.category_month, "category"),
        "region_multi": _over_orders(sales.region_multi, "customer_id", "region"),
        "channel_sales": _over_orders(sales.channel_sales, "channel"),
        "row_counts": _over_orders(sales.row_counts),
        "monthly_mom_yoy": _over_orders(catalogue.monthly_mom_yoy, "customer_id"),
        "region_month_rank": _over_orders(catalogue.region_month_rank, "customer_id", "region"),
        "category_contribution_monthly": _over_orders(
            catalogue.category_contribution_monthly, "category"
        ),
        "repurchase_ltv": _over_orders(catalogue.repurchase_ltv, *who),
        "channel_month": _over_orders(
            catalogue.channel_month, "customer_id", "channel", "discount_rate"
        ),
        "weekend_vs_weekday": _over_orders(catalogue.weekend_vs_weekday, "customer_id"),
        "payment_mix": _over_orders(catalogue.payment_mix, "payment_method"),
        "rfm_top100": _over_orders(catalogue.rfm_top, *who),
        "decline_alert": _over_orders(catalogue.decline_alert, "category"),
        "moving_average": _over_orders(trends.moving_average),
        "trend_ma7": _over_orders(trends.trend_ma7),
        "daily_series": _over_orders(trends.daily_series),
        "hw_grid": _over_orders(forecast.hw_grid),
        "sales_forecast": _over_orders(forecast.sales_forecast),
        "sales_forecast_by_category": _over_orders(
            forecast.sales_forecast, "category", keys=("category",)
        ),
        "sales_forecast_in_blocks": _importable(sales_forecast_in_blocks),
        "event_series_grid": _importable(event_series_grid),
        "forecast_total": forecast_total,
        "forecast_overlay": forecast_overlay,
        "rfm": _over_orders(rfm.rfm, *who),
        "rfm_scores": _over_orders(rfm.rfm_scores, *who),
        "segment_naming": segment_naming,
        "group_profile": lambda spark, d: rfm.cluster_profile(_type_groups(spark, d)),
        "group_summary": group_summary,
        "group_sizes": group_sizes,
        "customer_segments": lambda spark, d: rfm.customer_segments(_clusters(spark, d)),
        "cluster_profile": lambda spark, d: rfm.cluster_profile(_clusters(spark, d)),
        "segment_summary": lambda spark, d: rfm.segment_summary(
            rfm.customer_segments(_clusters(spark, d))
        ),
        "segment_sizes": lambda spark, d: rfm.segment_sizes(
            rfm.customer_segments(_clusters(spark, d))
        ),
        "insights": _over_orders(insights.insights),
        "insights_service": _over_orders(insights.insights, rows=insights.SERVICE_ROWS),
    }


def oracle_sql() -> dict[str, str]:
    return oracles() | (llm.oracle_sql() if llm else {})
