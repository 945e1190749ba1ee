"""Daily series with moving averages.

A daily series has one row per calendar day with sales, so the single ordered window that the
averages need is bounded by the calendar and not by the number of orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.numeric import ratio, summed
from tallymart.operators.filters import completed
from tallymart.params import Params


def daily_totals(df: DataFrame, keys: tuple[str, ...] = (), params: Params = Params()) -> DataFrame:
    """Exact revenue and order count per day, optionally for each value of ``keys``."""
    return (
        completed(df, params)
        .groupBy(*keys, F.to_date("order_date").alias("date"))
        .agg(summed().alias("total"), F.count("order_id").alias("orders"))
        .dropna(subset=[*keys, "date"])
    )


def trailing_mean(days: int, full_only: bool = False) -> Column:
    frame = Window.orderBy("date").rowsBetween(1 - days, 0)
    mean = ratio(F.sum("total").over(frame), F.count("total").over(frame))
    return F.when(F.count("total").over(frame) == days, mean) if full_only else mean


def moving_average(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Daily revenue and orders with averages that stay null until their window is full."""
    averages = {
        f"ma{days}": trailing_mean(days, full_only=True) for days in params.moving_average_days
    }
    return (
        daily_totals(df, params=params)
        .withColumns({**averages, "revenue": F.col("total").cast("double")})
        .select("date", "revenue", "orders", *averages)
        .orderBy("date")
    )


def trend_ma7(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Daily revenue with a seven-row average over however many rows there are so far."""
    return (
        daily_totals(df, params=params)
        .select(
            "date",
            F.col("total").cast("double").alias("revenue"),
            trailing_mean(7).alias("ma7"),
        )
        .orderBy("date")
    )


def daily_series(df: DataFrame, keys: tuple[str, ...] = (), params: Params = Params()) -> DataFrame:
    """Input of the forecast: (ds, y, order_count) per day, optionally per series key."""
    return (
        daily_totals(df, keys, params)
        .select(
            *keys,
            F.col("date").alias("ds"),
            F.col("total").cast("double").alias("y"),
            F.col("orders").alias("order_count"),
        )
        .orderBy(*keys, "ds")
    )
