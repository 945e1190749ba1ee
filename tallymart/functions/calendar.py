"""Calendar features of an order timestamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SATURDAY_SUNDAY = (5, 6)  # weekday() numbers, Monday is 0


def moment(name: str, forms: Sequence[str] = ()) -> Column:
    """A date cell as a moment without zone: ISO, or else the first of ``forms`` that fits."""
    cell = F.trim(F.col(name).cast("string"))
    whole = F.when(~cell.rlike(r"^\d{5,}$"), cell.try_cast("timestamp_ntz"))
    others = [F.try_to_timestamp(cell, F.lit(form)).cast("timestamp_ntz") for form in forms]
    return F.coalesce(whole, *others)


def sunday_week(ts: Column) -> Column:
    """Week of the year counted from the first Sunday (00 before it), two digits."""
    # dayofweek is 1 on Sunday, so this counts the Sundays up to and including ts.
    sundays = F.floor((F.dayofyear(ts) + 7 - F.dayofweek(ts)) / 7)
    return F.lpad(sundays.cast("string"), 2, "0")


def month_label(ts: Column) -> Column:
    # Formatting the date instead of the moment keeps the session zone out of it.
    return F.date_format(F.to_date(ts), "yyyy-MM")


def month_key(df: DataFrame) -> Column:
    """The stored month of an order table, else the month of the order date."""
    stored = "year_month" in df.columns
    return F.col("year_month") if stored else month_label(F.col("order_date"))


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts).isin(*SATURDAY_SUNDAY).cast("int")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two timestamps, independent of the session zone."""
    return F.extract(F.lit("DAY"), end - start).cast("long")


def time_features(ts: str = "order_date") -> dict[str, Column]:
    """The calendar columns by name."""
    t = F.col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "quarter": F.quarter(t),
        "week": F.weekofyear(t),
        "day_of_week": F.weekday(t),
        "day_name": F.date_format(F.to_date(t), "EEEE"),
        "is_weekend": is_weekend(t),
        "year_month": month_label(t),
        "year_week": F.concat(F.lpad(F.year(t), 4, "0"), F.lit("-W"), sunday_week(t)),
    }


def with_time_features(df: DataFrame, ts: str = "order_date") -> DataFrame:
    return df.withColumns(time_features(ts))
