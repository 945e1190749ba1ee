"""The chart tables of an interactive slice from one staged cube instead of a scan each.

One pass over the slice groups it two ways at once: by (day, category, region) for sums, and by
(customer, type) for what depends on how often a customer ordered, which sums by day cannot tell.
Both are combined map-side and go through one shuffle; the seven tables then read the small staged
result. Totals are exact decimals, so every table equals the one computed from the orders. The
cube of a whole order table answers any slice by days, categories and regions in the same way, but
for the customers' part, which holds for the slice it was made of.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.calendar import elapsed_days, month_label
from tallymart.functions.numeric import MONEY, percent_even, ratio, round_half_even, summed
from tallymart.operators.filters import completed, filter_orders
from tallymart.operators.trends import trailing_mean
from tallymart.params import ALL, DAY_LABELS, Params
from tallymart.sources.staging import stage

CELL = ("day", "category", "region")
CUSTOMER = ("customer_id", "customer_type")


def sales_cube(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """Completed orders by cell and by customer; ``of_customers`` tells the two kinds of rows apart."""
    done = completed(rows, params).select(
        F.to_date("order_date").alias("day"), "category", "region", *CUSTOMER, "order_id", "order_date",
        F.col("final_amount").try_cast(MONEY).alias("final_amount"),
    )
    grouped = done.groupingSets([[F.col(c) for c in CELL], [F.col(c) for c in CUSTOMER]], *CELL, *CUSTOMER)
    return grouped.agg(
        (F.grouping("day") == 1).alias("of_customers"),
        F.sum("final_amount").alias("revenue"),
        F.count("final_amount").alias("priced"),
        F.count(F.lit(1)).alias("records"),
        F.count("order_id").alias("orders"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("last"),
    )


def _total() -> Column:
    return F.coalesce(F.sum("revenue"), F.lit(0))


def _summed(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.dropna(subset=list(keys)).groupBy(*keys).agg(
        _total().alias("total"), F.sum("orders").alias("orders"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def _revenue_by(cells: DataFrame, *keys: str) -> DataFrame:
    return _summed(cells, *keys).select(*keys, F.col("total").cast("double").alias("revenue"))


def _kpi(customers: DataFrame) -> DataFrame:
    each = customers.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), *(F.sum(c).alias(c) for c in ("priced", "records", "orders"))
    )
    known = F.col("customer_id").isNotNull()
    repeat = F.count_if(known & (F.col("orders") > 1))
    return each.agg(
        _total().cast("double").alias("total_revenue"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("total_orders"),
        F.count("customer_id").alias("total_customers"),
        round_half_even(ratio(_total(), F.sum("priced")), 2).alias("avg_order_value"),
        percent_even(repeat, F.greatest(F.lit(1), F.count("customer_id")), 1).alias("repurchase_rate"),
    )


def _trend(cells: DataFrame) -> DataFrame:
    days = _summed(cells, "day").withColumnRenamed("day", "date")
    return days.select("date", F.col("total").cast("double").alias("revenue"), trailing_mean(7).alias("ma7")).orderBy("date")


def _weekday(cells: DataFrame) -> DataFrame:
    days = _summed(cells.withColumn("day_of_week", F.weekday("day")), "day_of_week")
    everything = Window.partitionBy()  # at most seven rows
    span = elapsed_days(F.min("first").over(everything), F.max("last").over(everything))
    return days.select(
        "day_of_week",
        F.get(F.array(*map(F.lit, DAY_LABELS)), F.col("day_of_week")).alias("day_name"),
        F.col("total").cast("double").alias("revenue"),
        "orders",
        ratio(F.col("total"), F.greatest(F.lit(1.0), span / 7)).alias("avg_revenue"),
    ).orderBy("day_of_week")


def _repurchase(customers: DataFrame) -> DataFrame:
    repeat, everyone = F.count_if(F.col("orders") > 1), F.count(F.lit(1))
    return customers.dropna(subset=list(CUSTOMER)).groupBy("customer_type").agg(
        everyone.alias("total"), repeat.alias("repeat"), percent_even(repeat, everyone, 1).alias("rate")
    ).orderBy("customer_type")


def dashboard_tables(cube: DataFrame) -> dict[str, DataFrame]:
    """The chart tables of a stored cube."""
    cells, customers = cube.filter("not of_customers"), cube.filter("of_customers")
    months = cells.withColumn("year_month", month_label(F.col("day")))
    return {
        "kpi": _kpi(customers),
        "trend": _trend(cells),
        "weekday": _weekday(cells),
        "category": _revenue_by(cells, "category").orderBy(F.desc("revenue"), "category"),
        "region": _revenue_by(cells, "region").orderBy(F.desc("revenue"), "region"),
        "repurchase": _repurchase(customers),
        "category_trend": _revenue_by(months, "year_month", "category").orderBy("year_month", "category"),
    }


def dashboard_datasets(
    df: DataFrame, start=None, end=None, category: str = ALL, region: str = ALL, params: Params = Params()
) -> dict[str, DataFrame]:
    """The chart tables of an interactive slice: one scan of the orders, then one small stored table."""
    return dashboard_tables(stage(sales_cube(filter_orders(df, start, end, category, region), params), "cube"))
