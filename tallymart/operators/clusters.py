"""k-means of weighted score combinations, as one expression over one row.

Customers are counted by their combination of scores, of which there are at most bins ** 3, so the
points of a table of any size fit in an array. A start takes the r-th heaviest point as its first
centre and adds the point of largest weighted squared distance to the nearest centre, which is
k-means++ without its draw. Lloyd steps fold over the array until no centre moves; the starts are
rows and run side by side, and the cheapest wins. Centres are means of whole scores, hence
quotients of whole numbers: every engine gets the same doubles, and no result depends on an order
of summation. Ties go to the first start, point or centre in ascending order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COST_UNITS = 1_000_000.0  # squared distances are summed in whole millionths


def _axes(struct: Column, names: Sequence[str]) -> list[Column]:
    return [struct[name] for name in names]


def _squared(point: Column, centre: Column, scale: Column, axes: Sequence[str]) -> Column:
    """Squared distance in deviations of each axis, summed from the first axis on."""
    parts = [(p - c) / s for p, c, s in zip(*(_axes(x, axes) for x in (point, centre, scale)))]
    total = parts[0] * parts[0]
    for part in parts[1:]:
        total = total + part * part
    return total


def _nearest(point: Column, centres: Column, scale: Column, axes: Sequence[str]) -> Column:
    """Squared distance and index of the nearest centre."""
    found = F.transform(
        centres, lambda c, i: F.struct(_squared(point, c, scale, axes).alias("far"), i.alias("index"))
    )
    return F.array_min(found)


def _as_centre(point: Column, axes: Sequence[str]) -> Column:
    return F.struct(*[point[a].cast("double").alias(a) for a in axes])


def _seeded(points: Column, first: Column, scale: Column, k: Column, axes: Sequence[str]) -> Column:
    def add(centres: Column, _: Column) -> Column:
        gains = F.transform(
            points,
            lambda p, i: F.struct((p["weight"] * _nearest(p, centres, scale, axes)["far"]).alias("gain"),
                                  (-i).alias("turn"), _as_centre(p, axes).alias("point")),
        )
        return F.concat(centres, F.array(F.array_max(gains)["point"]))

    more = F.slice(points, 1, F.greatest(k - 1, F.lit(0)))
    return F.aggregate(more, F.array(_as_centre(first, axes)), add)


def _moved(points: Column, centres: Column, scale: Column, axes: Sequence[str]) -> Column:
    """Each centre at the mean of its points; one without points stays."""
    owned = F.transform(
        points, lambda p: F.struct(p.alias("p"), _nearest(p, centres, scale, axes)["index"].alias("index"))
    )
    zero = F.struct(*[F.lit(0).cast("long").alias(a) for a in (*axes, "weight")])

    def mean(owned: Column, centre: Column, i: Column) -> Column:
        def add(total: Column, one: Column) -> Column:
            p = one["p"]
            sums = [(total[a] + p[a] * p["weight"]).alias(a) for a in axes]
            return F.struct(*sums, (total["weight"] + p["weight"]).alias("weight"))

        def divide(total: Column) -> Column:
            sums = [(total[a] / total["weight"]).alias(a) for a in axes]
            return F.when(total["weight"] > 0, F.struct(*sums)).otherwise(centre)

        return F.aggregate(F.filter(owned, lambda one: one["index"] == i), zero, add, divide)

    return F.flatten(F.transform(F.array(owned), lambda all_owned: F.transform(centres, lambda c, i: mean(all_owned, c, i))))


def _settled(points: Column, seeds: Column, scale: Column, axes: Sequence[str], steps: int) -> Column:
    def step(state: Column, _: Column) -> Column:
        # a lambda's argument is evaluated once, an expression at each of its places
        moved = F.array(_moved(points, state["centres"], scale, axes))
        after = F.transform(moved, lambda m: F.struct(m.alias("centres"), (m == state["centres"]).alias("done")))
        return F.when(state["done"], state).otherwise(after[0])

    start = F.struct(seeds.alias("centres"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)["centres"]


def _cost(points: Column, centres: Column, scale: Column, axes: Sequence[str]) -> Column:
    def add(total: Column, p: Column) -> Column:
        millionths = F.floor(_nearest(p, centres, scale, axes)["far"] * COST_UNITS)
        return total + p["weight"] * millionths

    return F.aggregate(points, F.lit(0).cast("long"), add)


def _scales(points: DataFrame, axes: Sequence[str]) -> Column:
    """The deviation of each axis over customers; 1 where all agree."""
    weight = F.sum("weight")
    parts = []
    for axis in axes:
        mean = F.sum(F.col(axis) * F.col("weight")) / weight
        square = F.sum(F.col(axis) * F.col(axis) * F.col("weight")) / weight
        spread = F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))
        parts.append(F.when(spread > 0, spread).otherwise(1.0).alias(axis))
    return F.struct(*parts)


def weighted_kmeans(
    points: DataFrame, axes: Sequence[str], k: int, restarts: int = 10, steps: int = 300
) -> DataFrame:
    """The axes and ``cluster`` of each point; clusters are numbered by their centres.

    ``points`` has whole numbers on the axes and a whole ``weight``, one row for each distinct
    point, and few enough rows for one array. Fewer points than ``k`` make a cluster each.
    """
    all_points = F.sort_array(F.collect_list(F.struct(*axes, "weight")))
    table = points.agg(all_points.alias("points"), _scales(points, axes).alias("scale"))
    heavy = F.array_sort("points", lambda p, q: F.when(p["weight"] > q["weight"], -1)
                         .when(p["weight"] < q["weight"], 1).when(p < q, -1).when(p > q, 1).otherwise(0))
    starts = table.select("*", F.posexplode(F.slice(heavy, 1, restarts)).alias("start", "first"))
    p, scale = F.col("points"), F.col("scale")
    seeds = _seeded(p, F.col("first"), scale, F.least(F.lit(k), F.size("points")), axes)
    settled = starts.withColumn("seeds", seeds).withColumn("centres", _settled(p, F.col("seeds"), scale, axes, steps))
    costed = settled.withColumn("cost", _cost(p, F.col("centres"), scale, axes))
    best = costed.agg(
        F.min_by(F.struct("points", "scale", F.array_sort("centres").alias("centres")), F.struct("cost", "start")).alias("b")
    ).select("b.*")
    cluster = _nearest(F.col("point"), F.col("centres"), F.col("scale"), axes)["index"]
    return best.select("scale", "centres", F.explode("points").alias("point")).select(
        *[F.col(f"point.{a}").alias(a) for a in axes], cluster.cast("int").alias("cluster")
    )
