"""The wide order-line view over star-schema Parquet tables, and its dirty variants."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.sources.schema import ORDER_COLUMNS

_FROM_PART = {"category", "product", "unit_price", "total_amount", "final_amount"}
_FROM_ORDERS = {"order_date", "channel", "customer_id", "order_status"}
_FROM_CUSTOMER = {"customer_type"}
_FROM_NATION = {"city", "region"}
_FROM_REGION = {"region"}


_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
        "l_discount double, l_returnflag string, l_linestatus string"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; the stated schema saves the job that would infer it."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


Days = tuple[str | None, str | None]


def _order_headers(
    spark: SparkSession, sf_dir: str, wanted: set[str], days: Days | None
) -> DataFrame:
    """Orders with the customer attributes that are wanted, joined at order grain."""
    headers = _table(spark, sf_dir, "orders")
    if days:
        first, last = (F.lit(day).cast("timestamp_ntz") for day in days)
        headers = headers.filter(F.col("o_orderdate") >= first) if days[0] else headers
        headers = headers.filter(F.col("o_orderdate") <= last) if days[1] else headers
    if wanted & (_FROM_CUSTOMER | _FROM_NATION):
        customer = _table(spark, sf_dir, "customer")
        headers = headers.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if wanted & _FROM_NATION:
        nation = _table(spark, sf_dir, "nation")
        headers = headers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    if wanted & _FROM_REGION:
        region = _table(spark, sf_dir, "region")
        headers = headers.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return headers


_TOTAL = "cast(p_retailprice * cast(l_quantity as int) as decimal(14,2))"
_DISCOUNT = "cast(l_discount as decimal(5,4))"

_EXPRESSIONS = {
    "order_id": "concat('ORD-', l_orderkey, '-', l_linenumber)",
    "order_date": (
        "o_orderdate + make_dt_interval("
        "0, cast(8 + l_orderkey % 15 as int), cast(l_partkey % 60 as int), 0)"
    ),
    "category": "p_type",
    "product": "p_name",
    "region": "r_name",
    "city": "n_name",
    "channel": "o_orderpriority",
    "customer_id": "concat('CUST-', o_custkey)",
    "customer_type": "c_mktsegment",
    "unit_price": "p_retailprice",
    "quantity": "cast(l_quantity as int)",
    "total_amount": _TOTAL,
    "discount_rate": _DISCOUNT,
    "final_amount": f"cast(round({_TOTAL} * (1 - {_DISCOUNT}), 2) as decimal(14,2))",
    "payment_method": "concat(l_returnflag, l_linestatus)",
    "order_status": "o_orderstatus",
}


def order_lines(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] = ORDER_COLUMNS,
    days: Days | None = None,
) -> DataFrame:
    """Order lines with the asked-for columns.

    ``days``, a first and a last day, limits the scan of the orders: the hours that the view adds
    to the stored day never leave it. Lines without such an order are then left out. Either day may
    be None.

    Every dimension hangs on by a left join on its primary key. Such a join neither drops nor
    repeats a line, so dimensions that supply none of the columns are not joined at all. Small
    dimensions are broadcast when their file size says so; large ones meet in shuffle joins
    that adaptive execution splits where a key is hot.
    """
    names = list(columns)
    wanted = set(names)
    lines = _table(spark, sf_dir, "lineitem")
    if days or wanted & (_FROM_ORDERS | _FROM_CUSTOMER | _FROM_NATION):
        headers = _order_headers(spark, sf_dir, wanted, days)
        how = "inner" if days else "left"
        lines = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), how)
    if wanted & _FROM_PART:
        # Prices become decimals here, once per part instead of once per line.
        price = F.col("p_retailprice").cast("decimal(12,2)")
        part = _table(spark, sf_dir, "part").withColumn("p_retailprice", price)
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    return lines.selectExpr(*[f"{_EXPRESSIONS[name]} AS {name}" for name in names])


def dirty_order_lines(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] = ORDER_COLUMNS
) -> DataFrame:
    """Order lines with faults planted by arithmetic on their keys.

    Missing prices, quantities, categories, regions and payment methods, the text "nan",
    inflated prices, negative quantities and impossible discounts; duplicate order ids are
    already in the data.
    """
    names = list(columns)
    source = order_lines(spark, sf_dir, list(dict.fromkeys([*names, "order_id", "unit_price"])))
    h = (
        "(cast(split_part(order_id, '-', 2) as bigint) * 31"
        " + cast(split_part(order_id, '-', 3) as bigint) * 17"
        " + cast(unit_price * 100 as bigint))"
    )
    price, discount = "cast(unit_price as double)", "cast(discount_rate as double)"
    faults = {
        "unit_price": f"CASE WHEN {h} % 50 = 0 THEN null WHEN {h} % 333 = 11 THEN {price} * 20 "
        f"ELSE {price} END",
        "quantity": f"CASE WHEN {h} % 67 = 1 THEN null WHEN {h} % 500 = 13 THEN -quantity "
        "ELSE quantity END",
        "discount_rate": f"CASE WHEN {h} % 1000 = 17 THEN 1.5D WHEN {h} % 1000 = 19 THEN 0.7D "
        f"ELSE {discount} END",
        "category": f"CASE WHEN {h} % 100 <> 3 THEN category END",
        "region": f"CASE WHEN {h} % 400 = 23 THEN 'nan' WHEN {h} % 200 <> 5 THEN region END",
        "payment_method": f"CASE WHEN {h} % 100 <> 7 THEN payment_method END",
    }
    return source.selectExpr(*[f"{faults.get(name, name)} AS {name}" for name in names])


def raw_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty lines as text cells: other forms of dates, unparsable dates and numbers, numbers
    beyond all bounds."""
    dirty = dirty_order_lines(spark, sf_dir)
    line = F.split(F.col("order_id"), "-")[1].cast("long")
    text = {n: F.col(n).cast("string") for n in ORDER_COLUMNS}
    date = F.col("order_date")
    text["order_date"] = (
        F.when(line % 97 == 5, F.lit("bad"))
        .when(line % 101 == 7, F.date_format(date, "yyyy/M/d"))
        .when(line % 103 == 9, F.date_format(date, "yyyyMMdd"))
        .otherwise(text["order_date"])
    )
    text["unit_price"] = (
        F.when(line % 89 == 3, F.lit("abc")).when(line % 907 == 2, F.lit("Infinity"))
        .when(line % 911 == 3, F.lit("1e999")).when(line % 919 == 4, F.lit("-Infinity"))
        .otherwise(text["unit_price"])
    )
    text["quantity"] = (
        F.when(line % 83 == 4, F.lit("")).when(line % 113 == 8, F.lit("99999999999999999999"))
        .otherwise(text["quantity"])
    )
    text["discount_rate"] = F.when(line % 79 == 6, F.lit("nan")).otherwise(text["discount_rate"])
    return dirty.select(*[text[n].alias(n) for n in ORDER_COLUMNS])
