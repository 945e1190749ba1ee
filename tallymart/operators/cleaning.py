"""Cleaning of raw orders: coerce, deduplicate, impute, cap outliers, add calendar columns.

Deduplicated orders are stored once, because the statistics and the rows both need them. All
statistics (median and quartile prices per category, the discount flag) come from one count of
the distinct (category, price) pairs, a table that is small next to the orders; that count reads
three columns of the stored orders. Applying the statistics is then a scan with a broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import narrow
from tallymart.functions.calendar import moment, with_time_features
from tallymart.functions.numeric import MONEY, clip, nan_to_null, percent_even, round_half_even
from tallymart.operators.ranks import weighted_quantiles
from tallymart.params import Params
from tallymart.sources.staging import stage
from tallymart.sources.schema import NUMERIC_COLUMNS, ORDER_COLUMNS, TEXT_COLUMNS

FILLED_COLUMNS = ("category", "region", "city", "payment_method")

_FILL, _UPPER, _COPIES = "_fill_price", "_upper_price", "_copies"


def _number(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        # A Java number literal such as "1.5d" is not a number in a data file.
        column = F.when(~F.rlike(column, F.lit(r"[0-9.]\s*[dDfF]\s*$")), column)
    return nan_to_null(column.try_cast("double"))


def coerce_types(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Parse dates and numbers, unparsable cells become null; the text "nan" means null."""
    present = set(df.columns)
    parsed = {"order_date": moment("order_date", params.date_forms)}
    parsed |= {n: _number(df, n) for n in NUMERIC_COLUMNS if n in present}
    parsed |= {n: F.nullif(F.col(n).cast("string"), F.lit("nan")) for n in TEXT_COLUMNS}
    return df.withColumns({n: c for n, c in parsed.items() if n in present})


def least_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """The first row of each group by ``order``, a null after every value, with the group's counts.

    The least row of a group is found map-side first, so a key that repeats without end sends one
    row per input partition through the shuffle.
    """
    fields = [df.schema[c] for c in order]
    # a null comes after every value
    cells = [c for i, (cell, nullable) in enumerate(narrow.packed(fields))
             for c in ([F.isnull(cell).alias(f"none{i}")] * nullable + [cell.alias(f"cell{i}")])]
    found = df.groupBy(*keys).agg(F.min(F.struct(*cells)).alias("_first"), *(c.alias(n) for n, c in counts.items()))
    names = [n for n in found.schema["_first"].dataType.names if n.startswith("cell")]
    place = narrow.unpacked(fields, [F.col(f"_first.{n}") for n in names])
    return found.select(*(place.get(c, F.col(c)).alias(c) for c in df.columns), *counts)


def drop_duplicate_orders(
    df: DataFrame, order_by: tuple[str, ...] = Params.duplicate_order, copies: str | None = None
) -> DataFrame:
    """Keep one row per order id: the first by ``order_by``, then by all other columns.

    ``copies`` names a column for how many rows the id had.
    """
    first = list(order_by)
    order = first + [c for c in df.columns if c not in {*first, "order_id"}]
    return least_rows(df, ["order_id"], order, {copies: F.count(F.lit(1))} if copies else {})


def _filled_label(params: Params) -> Column:
    return F.coalesce(F.col("category"), F.lit(params.unknown_label))


def price_counts(df: DataFrame) -> DataFrame:
    """How often each price occurs in each category, and whether a bad discount occurs there."""
    return df.groupBy("category", F.col("unit_price").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.max(_bad_discount()).alias("bad_discount")
    )


def median_prices(counts: DataFrame) -> DataFrame:
    """The price to impute per category: its median, else the median of all orders.

    The whole table is one more key of the same selection.
    """
    own = F.when(F.col("category").isNotNull(), F.struct(F.lit(True).alias("own"), "category"))
    everything = F.struct(F.lit(False).alias("own"), F.lit("").alias("category"))
    keyed = counts.dropna(subset=["value"]).select(F.inline(F.array_compact(F.array(own, everything))), "value", "n")
    found = weighted_quantiles(keyed, ["own", "category"], [0.5], out="_median")
    # one row per category
    medians = stage(found.select("own", "category", F.get("_median", F.lit(0)).alias("_median")), "medians")
    overall = medians.filter("not own").agg(F.max("_median").alias("_overall"))
    return (
        counts.select("category").distinct()
        .join(medians.filter("own").drop("own"), "category", "left")
        .crossJoin(F.broadcast(overall))
        .select("category", F.coalesce("_median", "_overall").alias(_FILL))
    )


def price_limits(
    counts: DataFrame, fills: DataFrame, params: Params = Params()
) -> DataFrame:
    """Upper price limit per filled category, over prices as they are after imputation."""
    fills = fills.withColumnRenamed("category", "_raw")
    imputed = (
        counts.join(fills, F.col("category").eqNullSafe(F.col("_raw")))
        .select(
            _filled_label(params).alias("_label"),
            F.coalesce("value", _FILL).alias("value"),
            "n",
        )
        .dropna(subset=["value"])
    )
    quartiles = weighted_quantiles(stage(imputed, "imputed-prices"), ["_label"], [0.25, 0.75])
    q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
    return quartiles.select("_label", (q3 + (q3 - q1) * params.iqr_multiplier).alias(_UPPER))


def category_prices(counts: DataFrame, params: Params) -> DataFrame:
    """One row per raw category (null included) with its fill price and upper limit."""
    fills = stage(median_prices(counts), "fill-prices")
    limits = price_limits(counts, fills, params)
    return fills.join(limits, _filled_label(params) == F.col("_label"), "left").drop("_label")


def _join_by_category(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Attach the category prices to the orders.

    The prices are stored, so that the size of their files decides on a broadcast; beyond it
    adaptive execution splits the orders of a hot category. Null categories match on a flag.
    """
    known = F.coalesce("category", F.lit("")).alias("_label"), F.col("category").isNull().alias("_none")
    prices = stage(prices, "category-prices").select(*known, _FILL, _UPPER)
    return df.select("*", *known).join(prices, ["_label", "_none"], "left").drop("_label", "_none")


def fill_labels(df: DataFrame, params: Params = Params()) -> DataFrame:
    present = [c for c in FILLED_COLUMNS if c in df.columns]
    return df.fillna(params.unknown_label, subset=present)


def fill_quantity(df: DataFrame, params: Params = Params()) -> DataFrame:
    """A missing quantity becomes the default; fractions are cut off.

    One beyond 64 bits cannot be a count and counts as missing too.
    """
    default = F.lit(params.default_quantity).cast("long")
    return df.withColumn("quantity", F.coalesce(F.col("quantity").try_cast("long"), default))


def _amounts(df: DataFrame, discount: Column) -> DataFrame:
    total = round_half_even(F.col("unit_price") * F.col("quantity"), 2)
    return df.withColumn("total_amount", total).withColumn(
        "final_amount", round_half_even(F.col("total_amount") * (1 - discount), 2)
    )


def _impute(df: DataFrame, params: Params) -> DataFrame:
    """Fill all gaps; expects the fill price column."""
    priced = df.withColumn("unit_price", F.coalesce("unit_price", _FILL))
    filled = fill_labels(fill_quantity(priced, params), params)
    return _amounts(filled, clip(F.col("discount_rate"), 0.0, 1.0))


def _cap(df: DataFrame, params: Params) -> DataFrame:
    """Tame outliers; expects the upper price and the discount flag columns."""
    discount = F.col("discount_rate")
    too_dear = F.col("unit_price") > F.col(_UPPER)
    capped = df.withColumns(
        {
            "quantity": F.when(
                F.col("quantity") < 0, F.try_subtract(F.lit(0), "quantity")
            ).otherwise(F.col("quantity")),
            "discount_rate": F.when(
                F.col("_any_bad_discount"), clip(discount, 0.0, params.max_discount_rate)
            ).otherwise(discount),
            "unit_price": F.when(too_dear, F.col(_UPPER)).otherwise(F.col("unit_price")),
        }
    )
    return _amounts(capped, F.col("discount_rate"))


def _null_cells(columns) -> Column:
    return sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))


def _bad_discount() -> Column:
    return F.coalesce((F.col("discount_rate") > 1) | (F.col("discount_rate") < 0), F.lit(False))


def _prepared(df: DataFrame, params: Params) -> DataFrame:
    """Deduplicated orders with their category prices and the table-wide discount flag."""
    unique = drop_duplicate_orders(coerce_types(df, params), params.duplicate_order, _COPIES)
    unique = stage(unique, "unique-orders")
    counts = stage(price_counts(unique), "price-counts")
    bad_discount = counts.agg(F.max("bad_discount")).first()[0]
    # One rate outside [0, 1] is enough to have every rate limited.
    return _join_by_category(unique, category_prices(counts, params)).withColumn(
        "_any_bad_discount", F.lit(bool(bad_discount))
    )


def _cleaned(df: DataFrame, params: Params) -> DataFrame:
    """Clean rows together with what was done to each of them."""
    columns = [c for c in ORDER_COLUMNS if c in df.columns]
    before = _prepared(df, params).withColumn("_nulls_before", _null_cells(columns))
    imputed = _impute(before, params).withColumns(
        {
            "_nulls_after": _null_cells(columns),
            "_negative": F.coalesce(F.col("quantity") < 0, F.lit(False)),
            "_bad_discount": _bad_discount(),
            "_too_dear": F.coalesce(F.col("unit_price") > F.col(_UPPER), F.lit(False)),
        }
    )
    return _cap(imputed, params)


def _typed_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(MONEY) for c in ("total_amount", "final_amount")})


def impute_orders(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Coerced, deduplicated and gap-free orders, outliers still in them."""
    columns = [c for c in ORDER_COLUMNS if c in df.columns]
    return _typed_amounts(_impute(_prepared(df, params), params)).select(*columns)


def cap_outliers(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Orders after outlier treatment, before calendar columns."""
    columns = [c for c in ORDER_COLUMNS if c in df.columns]
    return _typed_amounts(_cleaned(df, params)).select(*columns)


def clean_orders(df: DataFrame, params: Params = Params()) -> DataFrame:
    """The whole cleaning chain, one row per order."""
    return with_time_features(cap_outliers(df, params))


def price_cap_summary(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Upper price limit of each category and how many orders exceeded it."""
    return _cleaned(df, params).groupBy("category").agg(
        F.max(_UPPER).alias("upper_price"), F.count_if("_too_dear").alias("capped_orders")
    )


def null_profile(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Null cells over all columns before and after imputation."""
    return _cleaned(df, params).agg(
        F.coalesce(F.sum("_nulls_before"), F.lit(0)).alias("nulls_before"),
        F.coalesce(F.sum("_nulls_after"), F.lit(0)).alias("nulls_after"),
    )


def _report(treated: DataFrame, params: Params) -> DataFrame:
    """The raw rows are the copies of all orders: the pass that made them unique counted them, and
    no accumulator that a repeated task would raise again."""
    flags = ("_negative", "_bad_discount", "_too_dear")
    handled = sum((F.col(f).cast("int") for f in flags), F.lit(0))
    done = F.col("order_status") == params.completed_status
    # One row per customer carries all counters and the completed orders for the repeat rate.
    customers = treated.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_COPIES).alias("raw"),
        F.sum("_nulls_before").alias("before"),
        F.sum("_nulls_after").alias("after"),
        F.sum(handled).alias("handled"),
        F.count_if(done).alias("completed"),
        F.count_if(done & F.col("order_id").isNotNull()).alias("orders"),
    )
    known = F.col("customer_id").isNotNull()

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    removed = F.col("rows_before") - F.col("rows_after")
    return customers.agg(
        total("raw").alias("rows_before"),
        total("rows").alias("rows_after"),
        F.struct(total("before").alias("before"), total("after").alias("after")).alias("nulls"),
        total("handled").alias("outliers_handled"),
        percent_even(
            F.count_if(known & (F.col("orders") > 1)),
            F.count_if(known & (F.col("completed") > 0)),
            1,
        ).alias("repurchase_rate"),
    ).select(
        "rows_before", "rows_after", removed.alias("duplicates_removed"), "nulls", "outliers_handled", "repurchase_rate"
    )


def clean_with_report(df: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Clean orders and the one-row report on them, from a single deduplication."""
    columns = [c for c in ORDER_COLUMNS if c in df.columns]
    treated = _cleaned(df, params)
    orders = with_time_features(_typed_amounts(treated).select(*columns))
    return orders, _report(treated, params)


def clean_report(df: DataFrame, params: Params = Params()) -> DataFrame:
    """One row that says what cleaning did."""
    return clean_with_report(df, params)[1]
