"""Sales aggregations over completed orders.

Callers pass all orders; each function keeps the completed ones. Rows whose grouping key is
null are left out. Group totals are exact decimals and become doubles in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.calendar import elapsed_days, is_weekend, month_key
from tallymart.functions.numeric import growth_percent_even, percent_even, ratio, round_half_even, summed
from tallymart.operators.filters import completed, filter_orders
from tallymart.params import DAY_LABELS, Params


def _day() -> Column:
    return F.to_date("order_date")


def _aggregate(df: DataFrame, measures: list[str], **keys: Column) -> DataFrame:
    """Group by named key expressions (null keys dropped) and compute the named measures."""
    total = summed()
    catalogue = {
        "revenue": total.cast("double"),
        "orders": F.count("order_id"),
        "customers": F.count_distinct("customer_id"),
        "avg_order_value": ratio(total, F.count("final_amount")),
        "avg_price": ratio(
            F.sum(F.col("unit_price").cast("decimal(20,6)")), F.count("unit_price")
        ),
    }
    keyed = df.withColumns(keys).dropna(subset=list(keys))
    return keyed.groupBy(*keys).agg(*[catalogue[m].alias(m) for m in measures])


def with_share(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add the percentage of the column total to a table that has one row per label."""
    exact = F.col(value).cast("decimal(38,2)")
    return df.withColumn(out, percent_even(exact, F.sum(exact).over(Window.partitionBy()), 2))


def daily_sales(df: DataFrame, params: Params = Params()) -> DataFrame:
    measures = ["revenue", "orders", "customers", "avg_order_value"]
    return _aggregate(completed(df, params), measures, date=_day()).orderBy("date")


def daily_sales_range(df: DataFrame, start=None, end=None, params: Params = Params()) -> DataFrame:
    rows = filter_orders(completed(df, params), start=start, end=end)
    return _aggregate(rows, ["revenue", "orders"], date=_day()).orderBy("date")


def avg_daily_revenue(df: DataFrame, params: Params = Params()) -> DataFrame:
    daily = (
        completed(df, params)
        .groupBy(_day().alias("date"))
        .agg(summed().alias("revenue"))
        .dropna(subset=["date"])
    )
    return daily.agg(ratio(F.sum("revenue"), F.count("revenue")).alias("avg_daily_revenue"))


def category_contribution(df: DataFrame, params: Params = Params()) -> DataFrame:
    measures = ["revenue", "orders", "avg_price", "customers"]
    table = _aggregate(completed(df, params), measures, category=F.col("category"))
    return with_share(table, "revenue", "revenue_pct").orderBy(F.desc("revenue"), "category")


def category_sales(
    df: DataFrame, region: str | None = None, params: Params = Params()
) -> DataFrame:
    rows = filter_orders(completed(df, params), region=region)
    table = _aggregate(rows, ["revenue", "orders"], category=F.col("category"))
    return with_share(table, "revenue", "revenue_pct").orderBy(F.desc("revenue"), "category")


def category_total(df: DataFrame, ascending: bool = False, params: Params = Params()) -> DataFrame:
    table = _aggregate(completed(df, params), ["revenue"], category=F.col("category"))
    return table.orderBy(F.asc("revenue") if ascending else F.desc("revenue"), "category")


def category_month(df: DataFrame, params: Params = Params()) -> DataFrame:
    table = _aggregate(
        completed(df, params),
        ["revenue"],
        year_month=month_key(df),
        category=F.col("category"),
    )
    return table.orderBy("year_month", "category")


def export_summary(df: DataFrame, kind: str = "summary", params: Params = Params()) -> DataFrame:
    """Revenue by month and category; the only summary kind there is."""
    if kind != "summary":
        raise ValueError(f"unknown export format: {kind}")
    return category_month(df, params)


def monthly_region(df: DataFrame, params: Params = Params()) -> DataFrame:
    return _aggregate(
        completed(df, params),
        ["revenue", "orders"],
        year_month=month_key(df),
        region=F.col("region"),
    )


def region_sales(
    df: DataFrame, category: str | None = None, params: Params = Params()
) -> DataFrame:
    rows = filter_orders(completed(df, params), category=category)
    table = _aggregate(rows, ["revenue", "orders"], region=F.col("region"))
    return table.orderBy(F.desc("revenue"), "region")


def region_multi(df: DataFrame, params: Params = Params()) -> DataFrame:
    measures = ["revenue", "orders", "customers", "avg_order_value"]
    table = _aggregate(completed(df, params), measures, region=F.col("region"))
    return table.orderBy(F.desc("revenue"), "region")


def region_total(df: DataFrame, params: Params = Params()) -> DataFrame:
    table = _aggregate(completed(df, params), ["revenue"], region=F.col("region"))
    return table.orderBy(F.desc("revenue"), "region")


def channel_sales(df: DataFrame, params: Params = Params()) -> DataFrame:
    table = _aggregate(completed(df, params), ["revenue", "orders"], channel=F.col("channel"))
    return table.orderBy(F.desc("revenue"), "channel")


def monthly_sales(df: DataFrame, region: str | None = None, params: Params = Params()) -> DataFrame:
    """Monthly totals with growth against the previous month that has orders."""
    rows = filter_orders(completed(df, params), region=region)
    months = _aggregate(
        rows,
        ["revenue", "orders", "customers"],
        year_month=month_key(df),
    )
    # One row per calendar month, so a single ordered partition stays small at any scale.
    previous = F.lag("revenue").over(Window.orderBy("year_month"))
    return months.withColumn(
        "mom_growth", growth_percent_even(F.col("revenue"), previous, 2)
    ).orderBy("year_month")


def weekday_average(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Revenue per weekday over the number of weeks the completed orders span."""
    days = (
        completed(df, params)
        .groupBy(F.weekday("order_date").alias("day_of_week"))
        .agg(
            summed().alias("total"),
            F.count("order_id").alias("orders"),
            F.min("order_date").alias("_first"),
            F.max("order_date").alias("_last"),
        )
        .dropna(subset=["day_of_week"])
    )
    # At most seven rows are left here.
    everything = Window.partitionBy()
    span = elapsed_days(F.min("_first").over(everything), F.max("_last").over(everything))
    weeks = F.greatest(F.lit(1.0), span / 7)
    labels = F.array(*[F.lit(label) for label in DAY_LABELS])
    return days.select(
        "day_of_week",
        F.get(labels, F.col("day_of_week")).alias("day_name"),
        F.col("total").cast("double").alias("revenue"),
        "orders",
        ratio(F.col("total"), weeks).alias("avg_revenue"),
    ).orderBy("day_of_week")


def weekend_uplift(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Average revenue of a weekend day against a working day, in percent."""
    # Days first: the distinct-day counts become plain counts over one row per date.
    days = (
        completed(df, params)
        .groupBy(_day().alias("date"))
        .agg(summed().alias("revenue"))
        .dropna(subset=["date"])
        .withColumn("weekend", is_weekend(F.col("date")) == 1)
    )

    def average(flag: Column) -> Column:
        total = F.coalesce(F.sum(F.when(flag, F.col("revenue"))), F.lit(0))
        return ratio(total, F.greatest(F.lit(1), F.count_if(flag)))

    both = days.agg(
        average(F.col("weekend")).alias("weekend_avg"),
        average(~F.col("weekend")).alias("weekday_avg"),
    )
    weekend, weekday = F.col("weekend_avg"), F.col("weekday_avg")
    return both.withColumn(
        "uplift_pct", ratio(weekend - weekday, F.greatest(F.lit(1.0), weekday)) * 100
    )


def row_counts(df: DataFrame, params: Params = Params()) -> DataFrame:
    done = F.col("order_status") == params.completed_status
    return df.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(done).alias("completed_records")
    ).withColumn("healthy", F.col("records") > 0)


def kpi(
    df: DataFrame,
    category: str | None = None,
    region: str | None = None,
    year: int | None = None,
    start=None,
    end=None,
    params: Params = Params(),
) -> DataFrame:
    """One row of headline numbers.

    Pre-aggregating per customer turns the distinct count and the repeat rate into plain sums
    over one row per customer, and a customer with very many orders is combined map-side.
    """
    rows = filter_orders(completed(df, params), start, end, category, region, year)
    customers = rows.groupBy("customer_id").agg(
        summed().alias("revenue"),
        F.count("final_amount").alias("priced"),
        F.count(F.lit(1)).alias("records"),
        F.count("order_id").alias("orders"),
    )
    known = F.col("customer_id").isNotNull()
    total = F.coalesce(F.sum("revenue"), F.lit(0))
    return customers.agg(
        total.cast("double").alias("total_revenue"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("total_orders"),
        F.count("customer_id").alias("total_customers"),
        round_half_even(ratio(total, F.sum("priced")), 2).alias("avg_order_value"),
        percent_even(
            F.count_if(known & (F.col("orders") > 1)),
            F.greatest(F.lit(1), F.count("customer_id")),
            1,
        ).alias("repurchase_rate"),
    )
