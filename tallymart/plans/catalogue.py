"""The report catalogue: multi-dimensional queries over completed orders.

Unlike the aggregations in ``operators.sales`` these keep a group for null keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.calendar import is_weekend, month_key
from tallymart.functions.numeric import (
    amount,
    growth_percent,
    percent,
    ratio,
    round_half_up,
)
from tallymart.operators.filters import completed
from tallymart.operators.ranks import with_tiles
from tallymart.params import WEEKEND_LABEL, WORKDAY_LABEL, Params
from tallymart.sources.staging import stage


def _total() -> Column:
    return F.sum(amount())


def _average() -> Column:
    return ratio(_total(), F.count("final_amount"))


def _customers() -> Column:
    return F.count_distinct("customer_id")


def _by_month(df: DataFrame, params: Params, *keys: Column):
    month = month_key(df).alias("year_month")
    return completed(df, params).groupBy(*keys, month)


def monthly_mom_yoy(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Monthly totals with growth against the calendar month and year before."""
    months = _by_month(df, params).agg(
        _total().cast("double").alias("revenue"),
        F.count("order_id").alias("orders"),
        _customers().alias("customers"),
        _average().alias("avg_order_value"),
    )

    # A frame over the month number reaches exactly one or twelve months back, and is empty when
    # that month has no orders. One row per calendar month keeps the single partition small.
    first = F.to_date(F.concat("year_month", F.lit("-01")))
    numbered = months.withColumn("_month", F.year(first) * 12 + F.month(first))
    by_number = Window.orderBy("_month")

    def growth(gap: int) -> Column:
        base = F.first("revenue").over(by_number.rangeBetween(-gap, -gap))
        known = F.col("_month").isNotNull()
        return F.when(known, growth_percent(F.col("revenue"), base, 2))

    return (
        numbered.withColumns({"mom_growth_pct": growth(1), "yoy_growth_pct": growth(12)})
        .drop("_month")
        .orderBy("year_month")
    )


def region_month_rank(df: DataFrame, params: Params = Params()) -> DataFrame:
    table = _by_month(df, params, F.col("region")).agg(
        _total().cast("double").alias("revenue"),
        F.count("order_id").alias("order_count"),
        _customers().alias("customer_count"),
        round_half_up(_average(), 2).alias("avg_order_value"),
        round_half_up(ratio(_total(), _customers()), 2).alias("revenue_per_customer"),
    )
    best_first = Window.partitionBy("year_month").orderBy(F.desc("revenue"))
    return table.withColumn("region_rank", F.rank().over(best_first).cast("long")).orderBy(
        "year_month", F.desc("revenue")
    )


def _category_months(df: DataFrame, params: Params) -> DataFrame:
    return _by_month(df, params, F.col("category")).agg(
        _total().alias("total"), F.count("order_id").alias("order_count")
    )


def category_contribution_monthly(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Share of each category in its month and its change since its previous month."""
    table = _category_months(df, params).dropna(subset=["year_month"])
    month_total = F.sum("total").over(Window.partitionBy("year_month"))
    previous = F.lag("total").over(Window.partitionBy("category").orderBy("year_month"))
    return table.select(
        "category",
        "year_month",
        F.col("total").cast("double").alias("revenue"),
        "order_count",
        percent(F.col("total"), month_total, 2).alias("contribution_pct"),
        growth_percent(F.col("total"), previous, 2).alias("mom_change_pct"),
    ).orderBy("category", "year_month")


def repurchase_ltv(df: DataFrame, params: Params = Params()) -> DataFrame:
    customers = (
        completed(df, params)
        .groupBy("customer_id", "customer_type")
        .agg(
            F.count("order_id").alias("orders"),
            _total().alias("spent"),
            F.date_diff(F.max("order_date"), F.min("order_date")).alias("lifetime"),
        )
    )
    everyone, repeat = F.count(F.lit(1)), F.count_if(F.col("orders") > 1)
    return (
        customers.groupBy("customer_type")
        .agg(
            everyone.alias("total_customers"),
            repeat.alias("repeat_customers"),
            percent(repeat, everyone, 2).alias("repurchase_rate_pct"),
            round_half_up(ratio(F.sum("orders"), F.count("orders")), 2).alias(
                "avg_orders_per_customer"
            ),
            round_half_up(ratio(F.sum("spent"), F.count("spent")), 2).alias("avg_lifetime_value"),
            round_half_up(ratio(F.sum("lifetime"), F.count("lifetime")), 1).alias(
                "avg_lifetime_days"
            ),
        )
        .orderBy(F.desc("repurchase_rate_pct"), "customer_type")
    )


def channel_month(df: DataFrame, params: Params = Params()) -> DataFrame:
    discount = ratio(F.sum(F.col("discount_rate").cast("decimal(12,8)")), F.count("discount_rate"))
    return (
        _by_month(df, params, F.col("channel"))
        .agg(
            F.count("order_id").alias("orders"),
            _total().cast("double").alias("revenue"),
            _customers().alias("customers"),
            round_half_up(_average(), 2).alias("avg_order_value"),
            round_half_up(discount * 100, 2).alias("avg_discount_pct"),
        )
        .orderBy("year_month", F.desc("revenue"))
    )


def weekend_vs_weekday(df: DataFrame, params: Params = Params()) -> DataFrame:
    label = F.when(is_weekend(F.col("order_date")) == 1, WEEKEND_LABEL).otherwise(WORKDAY_LABEL)
    return (
        _by_month(df, params, label.alias("day_type"))
        .agg(
            F.count("order_id").alias("order_count"),
            _total().cast("double").alias("revenue"),
            round_half_up(_average(), 2).alias("avg_order_value"),
            _customers().alias("customer_count"),
        )
        .orderBy("year_month", "day_type")
    )


def payment_mix(df: DataFrame, params: Params = Params()) -> DataFrame:
    table = (
        completed(df, params)
        .groupBy("payment_method")
        .agg(
            F.count("order_id").alias("order_count"),
            F.count(F.lit(1)).alias("_rows"),
            _total().cast("double").alias("total_revenue"),
            round_half_up(_average(), 2).alias("avg_amount"),
        )
    )
    # One row per payment method is left here.
    everything = F.sum("_rows").over(Window.partitionBy())
    return (
        table.withColumn("pct_of_orders", percent(F.col("order_count"), everything, 2))
        .drop("_rows")
        .orderBy(F.desc("total_revenue"), "payment_method")
    )


def rfm_top(df: DataFrame, params: Params = Params()) -> DataFrame:
    """The customers with the best weighted recency, frequency and monetary tiles.

    Recency tiles count up with the days since the last order, as the score defines them.
    """
    as_of = F.lit(params.as_of) if params.as_of else F.current_date()
    customers = (
        completed(df, params)
        .groupBy("customer_id", "customer_type")
        .agg(
            F.count("order_id").alias("frequency"),
            _total().alias("spent"),
            F.to_date(F.max("order_date")).alias("recency_date"),
        )
        .withColumns(
            {
                "recency_days": F.date_diff(as_of, "recency_date").cast("long"),
                "_cents": (F.col("spent") * 100).cast("long"),
            }
        )
    )
    customers = stage(customers, "rfm-customers")
    scores = {"_r": "recency_days", "_f": "frequency", "_m": "_cents"}
    identity = ["customer_id", "customer_type"]
    tiled = with_tiles(customers, params.score_bins, scores, identity)
    weighted = sum(
        (F.col(tile) * F.lit(weight) for tile, weight in zip(scores, params.rfm_weights)),
        F.lit(0.0),
    )
    return (
        tiled.withColumn("rfm_score", round_half_up(weighted, 2))
        .orderBy(F.desc("rfm_score"), F.desc("spent"), "customer_id", "customer_type")
        .limit(params.top_n)
        .select(
            "customer_id",
            "customer_type",
            "frequency",
            F.col("spent").cast("double").alias("monetary"),
            "recency_date",
            "recency_days",
            "rfm_score",
        )
    )


def decline_alert(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Category months with at least two falls among the last three months on record."""
    by_month = Window.partitionBy("category").orderBy("year_month")
    changes = (
        _category_months(df, params)
        .withColumn("_previous", F.lag("total").over(by_month))
        .filter(F.col("_previous").isNotNull())
        .withColumn("_change", F.col("total") - F.col("_previous"))
    )
    falls = F.count_if(F.col("_change") < 0).over(by_month.rowsBetween(-2, 0))
    return (
        changes.withColumn("consecutive_declines", falls)
        .filter(F.col("consecutive_declines") >= 2)
        .select(
            "category",
            "year_month",
            F.col("total").cast("double").alias("revenue"),
            F.col("_change").cast("double").alias("month_over_month_change"),
            "consecutive_declines",
        )
        .orderBy(F.desc("year_month"), "category")
    )
