"""File sources and sinks of the order table, its metrics and reports."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions import narrow
from tallymart.functions.calendar import moment, with_time_features
from tallymart.operators.cleaning import least_rows
from tallymart.operators.filters import completed
from tallymart.params import Params
from tallymart.sources import csv_ranges
from tallymart.sources.csv_ranges import BYTE_ORDER_MARK
from tallymart.sources.schema import CLEAN_SCHEMA, RAW_TEXT_SCHEMA, REQUIRED
from tallymart.sources.staging import stage

# Cell texts that mean a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Quotes inside a quoted cell are doubled, and blanks around a text are kept.
CSV_STYLE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: Columns that place a row in its input: file, byte range and row in the range.
INPUT_ORDER = ("source_file", "source_block", "source_row")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_TEXT_SCHEMA,
    line_breaks: bool = True,
    params: Params = Params(),
    ordered: bool = False,
) -> DataFrame:
    """Read orders from CSV with a header; a cell that does not fit its type becomes null.

    Columns are found by the names in the header: their order is free, unknown ones are left
    out, and absent ones are absent from the result. A byte order mark is skipped. Dates may have
    any form that cleaning knows. Quoted cells may hold line breaks; a large file is split among
    many tasks all the same. Without ``line_breaks`` the pass that looks for open cells is saved.
    With ``ordered`` the columns of ``INPUT_ORDER`` are added: name them in
    ``Params.duplicate_order`` to keep the first copy of an order as the files have them.
    """
    reader = spark.read.options(**CSV_STYLE)
    header = [n.lstrip(BYTE_ORDER_MARK) for n in reader.option("multiLine", True).csv(path).columns]
    known = {f.name: f for f in schema}
    text = {name: T.StructField(name, T.StringType()) for name in header}
    fields = [text[name] if _is_moment(known.get(name)) else known.get(name, text[name]) for name in header]
    cells = [_cell(f, params) for f in schema if f.name in header]
    if not (line_breaks or ordered):
        rows = spark.read.options(**CSV_STYLE).schema(T.StructType(fields))
        return rows.option("enforceSchema", False).csv(path).select(*cells)
    found = csv_ranges.records(spark, path, header).filter("kind = 'whole'")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
    parsed = found.withColumn("cells", F.from_csv("record", ddl, CSV_STYLE))
    place = [F.col(c).alias(o) for c, o in zip(("file", "block", "row"), INPUT_ORDER)]
    return parsed.select("cells.*", *place).select(*cells, *(INPUT_ORDER if ordered else []))


def with_input_order(rows: DataFrame) -> DataFrame:
    """Add ``INPUT_ORDER`` to a table that was just read from Parquet files."""
    place = ("_metadata.file_path", "_metadata.file_block_start", "_metadata.row_index")
    return rows.select("*", *(F.col(c).alias(o) for c, o in zip(place, INPUT_ORDER)))


def _is_moment(field: T.StructField | None) -> bool:
    return field is not None and isinstance(field.dataType, T.TimestampNTZType)


def _cell(field: T.StructField, params: Params) -> Column:
    value = F.col(field.name)
    if _is_moment(field):
        return moment(field.name, params.date_forms).alias(field.name)
    if not isinstance(field.dataType, T.StringType):
        return value
    return F.when(~value.isin(*MISSING), value).alias(field.name)


def write_csv(df: DataFrame, path: str) -> None:
    """Write a folder of CSV parts; nulls are empty cells, moments keep their fractions.

    A folder whose name ends in ``.gz`` gets compressed parts, each of which is read by one task.
    """
    moments = {f.name: F.col(f.name).cast("string") for f in df.schema if _is_moment(f)}
    df = df.withColumns(moments) if moments else df
    df.write.mode("overwrite").options(**CSV_STYLE).csv(path, compression="gzip" if path.endswith(".gz") else "none")


def _by_month(df: DataFrame) -> DataFrame:
    """Bring the rows of a month together for writing.

    A rebalance, unlike a repartition, lets adaptive execution split a month that holds a third
    of all orders into many tasks and merge small months into one. Rows travel narrow.
    """
    slim = narrow.folded(df, ["year_month"])
    fields = [f for f in slim.schema if f.name != "year_month"]
    cells = [c.alias(f"_{i}") for i, (c, _) in enumerate(narrow.packed(fields))]
    moved = slim.select("year_month", *cells).hint("rebalance", "year_month")
    back = narrow.unpacked(fields, [F.col(f"_{i}") for i in range(len(cells))])
    return narrow.unfolded(moved.select("year_month", *(c.alias(n) for n, c in back.items())), df.columns)


def write_orders(df: DataFrame, path: str) -> None:
    """Write orders as Parquet in month folders, so that date filters skip whole months."""
    _by_month(df).write.mode("overwrite").partitionBy("year_month").parquet(path)


def insert_orders(df: DataFrame, table: str) -> None:
    """Append orders with calendar columns to a table made by ``create_order_table``.

    A null where the table has none stops the job. Rows of a file lie in order of their ids.
    """
    names = df.sparkSession.table(table).columns
    missing = {c: F.raise_error(F.lit(f"an order of {table} needs {c}")) for c in REQUIRED}
    checked = df.withColumns({c: F.coalesce(F.col(c), e.cast(df.schema[c].dataType)) for c, e in missing.items()})
    ordered = _by_month(checked).sortWithinPartitions("year_month", "order_id")
    ordered.select(*names).write.insertInto(table)


def insert_new_orders(df: DataFrame, table: str) -> DataFrame:
    """Append the orders whose ids the table does not have yet, one for each id.

    Returns what was rejected: order_id, order_date and a ``reason``, one of ``missing`` (an id or a
    date), ``repeated`` (another copy of the id went in) and ``exists``. The table is read in one column.
    One pass over the load makes it unique and counts what is missing: orders without an id are
    groups by their date.
    """
    spark = df.sparkSession
    no_id = F.col("order_id").isNull()
    date = F.when(no_id, F.coalesce(F.col("order_date").cast("string"), F.lit(""))).otherwise("-")
    rows = narrow.folded(df).withColumn("_date", date)
    order = ["order_date", *(c for c in rows.columns if c not in ("order_id", "order_date", "_date"))]
    counts = {"_copies": F.count("order_date"), "_undated": F.count_if(F.col("order_date").isNull())}
    unique = least_rows(rows, ["order_id", "_date"], order, counts)
    # the same keys, so that unique rows are not shuffled once more
    present = spark.table(table).select("order_id").distinct().select(
        "order_id", F.when(no_id, "").otherwise("-").alias("_date"), F.lit(True).alias("_exists")
    )
    known = stage(unique.join(present, ["order_id", "_date"], "left"), "known")
    keyed = known.filter(~no_id & (F.col("_copies") > 0))
    insert_orders(narrow.unfolded(keyed.filter("_exists is null"), df.columns), table)

    def rejected(rows: DataFrame, reason: str, times: Column) -> DataFrame:
        cells = F.explode(F.array_repeat(F.lit(reason), times.cast("int"))).alias("reason")
        return rows.select("order_id", "order_date", cells)

    nothing = F.lit(None).cast(df.schema["order_date"].dataType)
    return functools.reduce(DataFrame.unionByName, [
        rejected(known.filter(no_id), "missing", F.col("_copies") + F.col("_undated")),
        rejected(known.filter(~no_id).withColumn("order_date", nothing), "missing", F.col("_undated")),
        rejected(keyed, "repeated", F.col("_copies") - 1),
        keyed.filter("_exists").select("order_id", "order_date", F.lit("exists").alias("reason")),
    ])


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Read orders stored by month, with the types they were written with."""
    found = spark.read.parquet(path).schema
    # The month comes from folder names and must stay text.
    month = T.StructField("year_month", T.StringType())
    fields = {f.name: f for f in found} | {"year_month": month}
    stored = spark.read.schema(T.StructType(list(fields.values()))).parquet(path)
    order = [f.name for f in CLEAN_SCHEMA if f.name in fields]
    return stored.select(*order)


def load_orders(
    spark: SparkSession,
    path: str,
    params: Params = Params(),
    schema: T.StructType = CLEAN_SCHEMA,
) -> tuple[DataFrame, DataFrame]:
    """All stored orders from CSV with calendar columns derived anew, and the completed ones."""
    orders = with_time_features(read_csv(spark, path, schema, params=params))
    return orders, completed(orders, params)


def export_completed(df: DataFrame, path: str, params: Params = Params()) -> None:
    write_csv(completed(df, params), path)


def write_metrics(metrics: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder per metric table; returns where each went."""
    paths = {name: f"{folder}/metrics_{name}" for name in metrics}
    for name, table in metrics.items():
        write_csv(table, paths[name])
    return paths


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
