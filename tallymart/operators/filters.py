"""Row filters shared by the order queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.calendar import month_label
from tallymart.params import ALL, Params

DateLike = str | dt.date | dt.datetime


def completed(df: DataFrame, params: Params = Params()) -> DataFrame:
    return df.filter(F.col("order_status") == params.completed_status)


def _moment(value: DateLike) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def _in_months(df: DataFrame, first: Column | None, last: Column | None) -> DataFrame:
    """Repeat a date filter on the month folders of a stored table, so that a scan skips some."""
    if "year_month" not in df.columns:
        return df
    if first is not None:
        df = df.filter(F.col("year_month") >= month_label(first))
    if last is not None:
        df = df.filter(F.col("year_month") <= month_label(last))
    return df


def in_date_range(
    df: DataFrame, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Keep orders from ``start`` to ``end``, both read as moments.

    An end given as a date means its midnight, so orders later that day are left out.
    """
    first, last = (_moment(bound) if bound else None for bound in (start, end))
    if first is not None:
        df = df.filter(F.col("order_date") >= first)
    if last is not None:
        df = df.filter(F.col("order_date") <= last)
    return _in_months(df, first, last)


def in_year(df: DataFrame, year: int) -> DataFrame:
    """Keep the orders of a year, as a range of moments that the scan can use."""
    first, after = _moment(f"{year:04d}-01-01"), _moment(f"{year + 1:04d}-01-01")
    rows = df.filter((F.col("order_date") >= first) & (F.col("order_date") < after))
    return _in_months(rows, first, _moment(f"{year:04d}-12-01"))


def filter_orders(
    df: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    category: str | None = None,
    region: str | None = None,
    year: int | None = None,
) -> DataFrame:
    """Apply the filters that are given; an empty value or ``"all"`` means no filter."""
    df = in_date_range(df, start, end)
    if category and category != ALL:
        df = df.filter(F.col("category") == category)
    if region and region != ALL:
        df = df.filter(F.col("region") == region)
    if year:
        df = in_year(df, year)
    return df


def filter_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null values of each column, over all orders, as (name, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .dropna(subset=["value"])
        .distinct()
        .orderBy("name", "value")
    )


def date_bounds(df: DataFrame) -> DataFrame:
    day = F.to_date("order_date")
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
