"""The batch run: raw orders in, clean orders, metrics, forecast, segments and insights out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallymart.operators import cleaning, customers, forecast, insights, rfm, sales
from tallymart.params import Params
from tallymart.sources import files
from tallymart.sources.staging import staging


@dataclass(frozen=True)
class BatchResult:
    orders: DataFrame
    report: DataFrame
    forecast: DataFrame
    segments: DataFrame
    insights: DataFrame
    metrics: dict[str, DataFrame] = field(default_factory=dict)


def base_metrics(orders: DataFrame, params: Params = Params()) -> dict[str, DataFrame]:
    """The metric tables that are stored with every cleaning."""
    return {
        "daily_sales": sales.daily_sales(orders, params),
        "category_contribution": sales.category_contribution(orders, params),
        "customer_orders": customers.customer_orders(orders, params),
        "monthly_region": sales.monthly_region(orders, params),
    }


def _stored(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def run(spark: SparkSession, raw: DataFrame, folder: str, params: Params = Params()) -> BatchResult:
    """Clean once, store the result, and compute everything else from the stored table.

    Reading the written table back cuts the lineage: a lost executor re-reads month folders
    instead of repeating the cleaning, and each metric scans only its own columns. Intermediate
    tables are deleted when forecast and segments are stored.
    """
    with staging(spark):
        clean, report = cleaning.clean_with_report(raw, params)
        files.write_orders(clean, f"{folder}/orders")
        files.write_report(report, f"{folder}/cleaning_report")
        orders = files.read_orders(spark, f"{folder}/orders")
        metrics = base_metrics(orders, params)
        files.write_metrics(metrics, folder)
        predicted = forecast.sales_forecast(orders, params=params)
        segments = rfm.customer_segments(rfm.cluster_customers(orders, params))
        stored = {
            name: _stored(table, f"{folder}/{name}")
            for name, table in {"forecast": predicted, "segments": segments}.items()
        }
    return BatchResult(
        orders=orders,
        report=spark.read.schema(report.schema).json(f"{folder}/cleaning_report"),
        **stored,
        insights=insights.insights(orders, params=params),
        metrics=metrics,
    )
