"""Schema of the order table and its DDL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The columns of an order, their types, and what cleaning takes them for.
_COLUMNS = (
    ("order_id", T.StringType(), "key"),
    ("order_date", T.TimestampNTZType(), "moment"),
    ("category", T.StringType(), "text"),
    ("product", T.StringType(), "text"),
    ("region", T.StringType(), "text"),
    ("city", T.StringType(), "text"),
    ("channel", T.StringType(), "text"),
    ("customer_id", T.StringType(), "text"),
    ("customer_type", T.StringType(), "text"),
    ("unit_price", T.DecimalType(12, 2), "number"),
    ("quantity", T.IntegerType(), "number"),
    ("total_amount", T.DecimalType(14, 2), "number"),
    ("discount_rate", T.DecimalType(5, 4), "number"),
    ("final_amount", T.DecimalType(14, 2), "number"),
    ("payment_method", T.StringType(), "text"),
    ("order_status", T.StringType(), "text"),
)

ORDER_COLUMNS = tuple(name for name, _, _ in _COLUMNS)
TEXT_COLUMNS = tuple(name for name, _, role in _COLUMNS if role == "text")
NUMERIC_COLUMNS = tuple(name for name, _, role in _COLUMNS if role == "number")

ORDER_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind, _ in _COLUMNS])

# A file that may hold bad cells is read as text and coerced by the cleaning step.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ORDER_COLUMNS])

TIME_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("year_week", T.StringType()),
    ]
)

# Capped and imputed prices are interpolated quantiles, hence not whole cents.
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.DoubleType())
        if f.name in ("unit_price", "discount_rate")
        else f
        for f in ORDER_SCHEMA
    ]
    + TIME_SCHEMA.fields
)


# Columns that an order in the table must have; file tables do not enforce it, inserting does.
REQUIRED = ("order_id", "order_date")
# Columns by which single orders are looked up: a Bloom filter in every file skips the others.
LOOKED_UP = ("order_id", "customer_id")


def create_order_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the Parquet order table.

    Month folders, the order of rows within files and Bloom filters stand in for indexes on the
    date, the month, the order and the customer; columns of few values need none in this format.
    """
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{' NOT NULL' * (f.name in REQUIRED)}"
        for f in ORDER_SCHEMA.fields + [f for f in TIME_SCHEMA if f.name != "year_month"]
    )
    filters = ", ".join(f"'parquet.bloom.filter.enabled#{name}' 'true'" for name in LOOKED_UP)
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `year_month` string) "
        f"USING parquet OPTIONS ({filters}) PARTITIONED BY (year_month){where}"
    )
