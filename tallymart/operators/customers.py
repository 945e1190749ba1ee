"""Customer order counts and repurchase rates over completed orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.numeric import percent_even, summed
from tallymart.operators.filters import completed
from tallymart.params import Params


def _per_customer(df: DataFrame, *keys: str) -> DataFrame:
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("order_id").alias("order_count"), summed().alias("total"))
    )


def customer_orders(df: DataFrame, params: Params = Params()) -> DataFrame:
    return _per_customer(completed(df, params), "customer_id").select(
        "customer_id", "order_count", F.col("total").cast("double").alias("total_spent")
    )


def repurchase_overall(df: DataFrame, params: Params = Params()) -> DataFrame:
    customers = _per_customer(completed(df, params), "customer_id")
    repeat = F.count_if(F.col("order_count") > 1)
    return customers.agg(
        F.count(F.lit(1)).alias("customers"),
        repeat.alias("repeat_customers"),
        percent_even(repeat, F.count(F.lit(1)), 1).alias("repurchase_rate"),
    )


def repurchase_by_type(df: DataFrame, params: Params = Params()) -> DataFrame:
    customers = _per_customer(completed(df, params), "customer_id", "customer_type")
    repeat = F.count_if(F.col("order_count") > 1)
    return (
        customers.groupBy("customer_type")
        .agg(
            F.count(F.lit(1)).alias("total"),
            repeat.alias("repeat"),
            percent_even(repeat, F.count(F.lit(1)), 1).alias("rate"),
        )
        .orderBy("customer_type")
    )
