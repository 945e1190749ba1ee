"""Exact quantiles and tiles of columns of any size.

Both need the value at a given position of a sorted column. Values are first counted, so a value
that repeats a billion times is one row. A mergeable KLL sketch of the distinct values of each key
gives bounds that cut them into cells of about equal number; the cell totals, added up in order,
tell which cell holds each wanted position. The pass that adds up the cells sketches each of them
too, so where one still has more values than a task may sort, the next pass cuts it further. The
sketches only choose bounds, which are values themselves: infinities and doubles that differ in
their last digits are cut like any others, and positions are exact whatever the bounds. Each pass
leaves a small share of the values; 50,000 times the number of cells are settled in two. There is
no other way for small tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.sources.staging import stage

CELLS = 128
SKETCH_SIZE = 1024  # ranks are right within about 0.3 %
SORTED_VALUES = 50_000  # distinct values of a cell that one task may sort
TIE_PREFIX = 4  # hex digits of the tie key, 65,536 buckets
TIE_DIGITS = 32


def _before(weight: str, keys: Sequence[str], order: str) -> Column:
    frame = (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(weight).over(frame), F.lit(0))


def _holds(rank: Column, below: Column, weight: Column) -> Column:
    return (rank >= below) & (rank < below + weight)


def _bounds(value: str) -> Column:
    """Values that cut a group into ``CELLS`` cells of about as many distinct values each.

    Without a number among the values there are no bounds and one cell.
    """
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_SIZE))
    shares = F.array(*[F.lit(i / CELLS) for i in range(1, CELLS)])
    least = F.min(F.col(value).cast("double"))
    usable = least.isNotNull() & ~F.isnan(least)
    found = F.when(usable, F.array_distinct(F.kll_sketch_get_quantile_double(sketch, shares)))
    return F.coalesce(found, F.array().cast("array<double>"))


def _cell(value: Column) -> Column:
    """How many of the bounds are no greater than the value; it never falls as the value grows."""
    return F.size(F.filter("_bounds", lambda bound: bound <= value.cast("double")))


def select_ranks(
    counts: DataFrame,
    keys: Sequence[str],
    ranks: Callable[[Column], Column],
    value: str = "value",
    weight: str = "n",
) -> DataFrame:
    """Rows at the wanted zero-based positions of each key's sorted, weighted values.

    ``counts`` is a stored table of (keys, value, weight) with non-null keys and values; ``ranks``
    maps the total weight of a key to an array of positions. Returns (keys, rank, value, below,
    total), where ``below`` is the weight sorted before the returned row.
    """
    keys = list(keys)
    v = F.col(value)
    ends = counts.groupBy(*keys).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.sum(weight).alias("total"),
        F.count(F.lit(1)).alias("_kinds"), _bounds(value).alias("_bounds"),
    )
    wanted = stage(
        ends.select(*keys, "_low", "_high", F.lit(0).cast("long").alias("_start"), "_kinds", "total", "_bounds",
                    F.explode(ranks(F.col("total"))).alias("rank")),
        "wanted-ranks",
    )
    cell = [*keys, "_low", "_high"]
    kinds, most = None, wanted.agg(F.max("_kinds")).first()[0] or 0
    # Values that are one double cannot be cut; then a pass changes nothing and they are sorted as they are.
    while most > SORTED_VALUES and most != kinds:
        spans = wanted.groupBy(*cell).agg(F.first("_bounds").alias("_bounds"))
        inside = counts.join(spans, keys).filter(v.between(F.col("_low"), F.col("_high")))
        cells = (
            inside.withColumn("_cell", _cell(v))
            .groupBy(*cell, "_cell")
            .agg(F.sum(weight).alias("_n"), F.min(value).alias("_least"), F.max(value).alias("_most"),
                 F.count(F.lit(1)).alias("_values"), _bounds(value).alias("_next"))
            .withColumn("_before", _before("_n", cell, "_cell"))
        )
        first = F.col("_start") + F.col("_before")
        wanted = stage(
            wanted.drop("_bounds").join(cells, cell).filter(_holds(F.col("rank"), first, F.col("_n")))
            .select(*keys, F.col("_least").alias("_low"), F.col("_most").alias("_high"),
                    first.alias("_start"), F.col("_values").alias("_kinds"), "total", F.col("_next").alias("_bounds"),
                    "rank"),
            "wanted-ranks",
        )
        kinds, most = most, wanted.agg(F.max("_kinds")).first()[0] or 0
    spans = wanted.select(*cell, "_start", "total").distinct()
    inside = counts.join(spans, keys).filter(v.between(F.col("_low"), F.col("_high")))
    below = F.col("_start") + _before(weight, cell, value)
    placed = inside.withColumn("below", below).select(
        *cell, F.col(value).alias("_value"), "below", F.col(weight).alias("_n")
    )
    return (
        wanted.join(placed, cell)
        .filter(_holds(F.col("rank"), F.col("below"), F.col("_n")))
        .select(*keys, "rank", F.col("_value").alias(value), "below", "total")
    )


def weighted_quantiles(
    counts: DataFrame,
    keys: Sequence[str],
    probabilities: Sequence[float],
    value: str = "value",
    weight: str = "n",
    out: str = "quantiles",
) -> DataFrame:
    """Linearly interpolated quantiles per key as one array column."""

    def position(p: float, total: Column) -> Column:
        return (total - 1) * F.lit(float(p))

    def wanted(total: Column) -> Column:
        ends = [f(position(p, total)) for p in probabilities for f in (F.floor, F.ceil)]
        return F.array_distinct(F.array(*ends))

    # At most two values per probability are gathered for a key.
    found = (
        select_ranks(counts, keys, wanted, value, weight)
        .groupBy(*keys)
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("rank", F.col(value).cast("double")))
            ).alias("_at"),
            F.max("total").alias("_total"),
        )
    )

    def interpolate(p: float) -> Column:
        at = position(p, F.col("_total"))
        low = F.element_at("_at", F.floor(at))
        high = F.element_at("_at", F.ceil(at))
        share = at - F.floor(at)
        # The arithmetic of the built-in percentile, to the last bit.
        mixed = (F.ceil(at) - at) * low + share * high
        return F.when(low == high, low).otherwise(mixed)

    return found.select(*keys, F.array(*[interpolate(p) for p in probabilities]).alias(out))


def _tile_starts(n: int, rows: int) -> list[int]:
    """First position of tiles 2..n when the first rows % n tiles get one row more."""
    starts = (rows // n * k + min(k, rows % n) for k in range(1, n))
    return [s for s in starts if s < rows]


def _common_type(df: DataFrame, column: str) -> str:
    """Numbers keep their kind: whole ones and decimals are compared exactly."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return "long"
    return f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "double"


def with_tiles(
    df: DataFrame, n: int, columns: dict[str, str], tie_columns: Sequence[str]
) -> DataFrame:
    """Add ntile(n) numbers of several columns, each over the whole table in ascending order.

    Nulls come first. Rows of equal value are ordered by a hash of ``tie_columns``, which must
    identify a row. Only the n - 1 rows where a tile starts are looked up, here and now; every row
    then finds its tile by comparing itself with them, so the table is neither sorted nor shuffled.
    ``df`` should be a stored table, since it is read several times.
    """
    identity = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in tie_columns])
    tiled = df.withColumn("_tie", F.concat(F.md5(identity), F.lit("|"), identity))
    alike: dict[str, dict[str, str]] = {}
    for out, column in columns.items():
        alike.setdefault(_common_type(df, column), {})[out] = column
    source = tiled
    for common, own in alike.items():
        tiled = _with_tiles_of_kind(tiled, source, n, own, common)
    return tiled.drop("_tie")


@dataclass(frozen=True)
class _Cut:
    """The place where a tile of a metric starts: the ``offset``-th of ``alike`` rows of one value."""

    metric: str
    value: Any
    offset: int
    alike: int
    prefix: str = ""

    @property
    def name(self) -> str:
        return f"{self.metric}|{self.prefix}|{self.offset}|{self.value}"


def _cuts(counts: DataFrame, n: int, common: str) -> list[_Cut]:
    """Where the tiles of each metric start, from the counts of its values.

    A metric has at most n - 1 of them, so the driver holds the wanted positions, and what a pass
    finds for them, whatever the size of the table. Nulls are sorted before all values.
    """
    spark = counts.sparkSession
    v, known = F.col("value"), F.col("value").isNotNull()
    cuts: list[_Cut] = []
    wanted: list[tuple] = []
    ends = counts.groupBy("metric").agg(
        F.min("value"), F.max("value"), F.count("value"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)), _bounds("value"),
    )
    for metric, low, high, kinds, values, nulls, bounds in ends.collect():
        for start in _tile_starts(n, values + nulls):
            if start < nulls:
                cuts.append(_Cut(metric, None, start, nulls))
            else:
                wanted.append((metric, low, high, 0, kinds, bounds, start - nulls))
    schema = f"metric string, _low {common}, _high {common}, _start long, _kinds long, _bounds array<double>, rank long"
    cell = ["metric", "_low", "_high"]
    first = F.col("_start") + F.col("_before")

    def inside(spans: DataFrame) -> DataFrame:
        distinct = spans.dropDuplicates(cell).drop("rank")
        return counts.filter(known).join(F.broadcast(distinct), "metric").filter(v.between(F.col("_low"), F.col("_high")))

    most = None
    while wanted and max(w[4] for w in wanted) > SORTED_VALUES and max(w[4] for w in wanted) != most:
        most = max(w[4] for w in wanted)
        spans = spark.createDataFrame(wanted, schema)
        cells = (
            inside(spans).withColumn("_cell", _cell(v)).groupBy(*cell, "_start", "_cell")
            .agg(F.sum("n").alias("_n"), F.min("value").alias("_least"), F.max("value").alias("_most"),
                 F.count(F.lit(1)).alias("_values"), _bounds("value").alias("_next"))
            .withColumn("_before", _before("_n", cell, "_cell"))
        )
        ranks = F.broadcast(spans.select(*cell, "rank"))
        found = cells.join(ranks, cell).filter(_holds(F.col("rank"), first, F.col("_n")))
        wanted = [tuple(r) for r in found.select("metric", "_least", "_most", first, "_values", "_next", "rank").collect()]
    if wanted:
        spans = spark.createDataFrame(wanted, schema)
        placed = inside(spans).withColumn("_before", _before("n", cell, "value"))
        found = placed.join(F.broadcast(spans.select(*cell, "rank")), cell)
        found = found.filter(_holds(F.col("rank"), first, F.col("n")))
        cuts += [_Cut(*r) for r in found.select("metric", "value", F.col("rank") - first, "n").collect()]
    return cuts


def _tied_starts(values: DataFrame, cuts: list[_Cut], common: str) -> list[tuple[str, Any, str]]:
    """Metric, value and tie key of the row where each tile starts.

    Rows of equal value are narrowed by the digits of their tie keys until a task can sort them.
    """
    spark = values.sparkSession
    # A value becomes text for the join, so that null meets null.
    text = F.coalesce(F.col("value").cast("string"), F.lit("null")).alias("_value")
    schema = f"metric string, value {common}, _prefix string, _offset long, _name string"

    def tied() -> DataFrame:
        rows = [(c.metric, c.value, c.prefix, c.offset, c.name) for c in cuts]
        places = spark.createDataFrame(rows, schema).select("metric", text, "_prefix", "_offset", "_name")
        joined = values.select("metric", text, "_tie").join(F.broadcast(places), ["metric", "_value"])
        return joined.filter(F.startswith("_tie", F.col("_prefix")))

    while max(c.alike for c in cuts) > SORTED_VALUES and len(cuts[0].prefix) < TIE_DIGITS:
        by_name = {c.name: c for c in cuts}
        longer = F.left("_tie", F.lit(len(cuts[0].prefix) + TIE_PREFIX)).alias("_longer")
        groups = tied().groupBy("_name", "_offset", longer).agg(F.count(F.lit(1)).alias("_n"))
        groups = groups.withColumn("_start", _before("_n", ["_name"], "_longer"))
        held = groups.filter(_holds(F.col("_offset"), F.col("_start"), F.col("_n")))
        cuts = [
            replace(by_name[r["_name"]], prefix=r["_longer"], offset=r["_offset"] - r["_start"], alike=r["_n"])
            for r in held.collect()
        ]
    by_name = {c.name: c for c in cuts}
    place = F.row_number().over(Window.partitionBy("_name").orderBy("_tie")) - 1
    starts = tied().withColumn("_place", place).filter(F.col("_place") == F.col("_offset"))
    return [(by_name[r[0]].metric, by_name[r[0]].value, r[1]) for r in starts.select("_name", "_tie").collect()]


def _with_tiles_of_kind(
    tiled: DataFrame, source: DataFrame, n: int, columns: dict[str, str], common: str
) -> DataFrame:
    """Tiles of columns that compare in one type, ordered by each and then by ``_tie``."""
    pairs = [
        F.struct(F.lit(out).alias("metric"), F.col(c).cast(common).alias("value"))
        for out, c in columns.items()
    ]
    values = source.select("_tie", F.inline(F.array(*pairs)))
    counts = stage(values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    cuts = _cuts(counts, n, common)
    starts = _tied_starts(values, cuts, common) if cuts else []

    def tile(out: str, column: str) -> Column:
        own = F.struct(F.col(column).cast(common).alias("value"), F.col("_tie").alias("tie"))
        at = [
            F.struct(F.lit(value).cast(common).alias("value"), F.lit(tie).alias("tie"))
            for metric, value, tie in starts if metric == out
        ]
        reached = F.size(F.filter(F.array(*at), lambda cut: cut <= own)) if at else F.lit(0)
        return (reached + 1).cast("long")

    return tiled.withColumns({out: tile(out, column) for out, column in columns.items()})
