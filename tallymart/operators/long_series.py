"""Holt-Winters for series of any length: blocks of values, composed by a prefix product.

A smoothing step is an affine map of the state (level, trend and one term for each place in the
season), and its matrix is the same for every value. So a block of values is a power of that matrix
and the state that the block leaves when it starts from zero. Passes over all blocks in parallel,
each with all parameter sets at once, give what the fold over the whole series gives, but for
rounding:

1. every block is folded from zero, the first one from the averages of the first two seasons;
2. the states between blocks are the prefix product of these maps: the blocks of a group are
   composed to the map of the group, the groups to groups of groups, until one is left; then the
   states before the groups go down to the groups and blocks within;
3. every block is folded again from the state before it, for squared errors and fitted values.

Points are ``keys``, ``t`` and ``y``; a series is in order of t and, where t repeats, of y. Points
with a null t or y are left out. The season follows the place in the series, as in ``forecast``. A
series shorter than two seasons gets null results; an empty table gives none.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.operators.forecast import PENALTY, _sets, parameter_sets
from tallymart.params import Params
from tallymart.sources.staging import stage

BLOCK = 4096
#: Maps that one task composes one after the other.
GROUP = 256
#: Blocks that are folded side by side.
TOGETHER = 64

Sets = Sequence[tuple[float, float, float]]


def _left(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"a.`{k}`").alias(k) for k in keys]


def _same(keys: Sequence[str]) -> list[Column]:
    """Equal keys of two tables named a and b; null keys are a series like any other."""
    return [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]


def numbered(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, t, y and the place n of each point in its series, from 0; no series is in one task."""
    order = [*keys, "t", "y"]
    points = points.select(*keys, "t", F.col("y").cast("double").alias("y")).dropna(subset=["t", "y"])
    placed = stage(
        points.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}),
        "placed",
    )
    # one row for each part that a series has in a partition
    parts = placed.groupBy(*keys, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_count"))
    before = F.sum("_count").over(
        Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_count")
    together = placed.alias("a").join(parts.alias("b"), _same([*keys, "_part"]))
    return together.select(
        *_left(keys), "t", "y", (F.col("_id") - F.col("_first") + F.col("_before")).alias("n")
    )


def _blocks(points: DataFrame, keys: Sequence[str], block: int) -> DataFrame:
    """One row for each block of a series: its number k, days ts and values ys, and the length of the series."""
    point = F.struct("n", "t", "y")
    rows = numbered(points, keys).groupBy(*keys, F.floor(F.col("n") / block).alias("k")).agg(
        F.array_sort(F.collect_list(point)).alias("points")
    )
    rows = stage(
        rows.select(*keys, "k", F.col("points.t").alias("ts"), F.col("points.y").alias("ys")), "blocks"
    )
    # every series gets a number, so that later joins need not care for null keys
    series = rows.groupBy(*keys).agg(F.sum(F.size("ys")).alias("length"), F.max("k").alias("last"))
    series = stage(series.withColumn("series", F.monotonically_increasing_id()), "series")
    a, b = rows.alias("a"), series.alias("b")
    joined = a.join(b, _same(keys)) if keys else a.crossJoin(b)  # without keys there is one series
    return stage(joined.select(*_left(keys), "series", "k", "ts", "ys", "length", "last"), "series-blocks")


# --- folds ----------------------------------------------------------------------------------


def _begin(ys: np.ndarray, n_sets: int, season: int) -> tuple[np.ndarray, np.ndarray]:
    """States after the first season of a series, from the averages of two, and the fitted values."""
    first, second = ys[:season], ys[season : 2 * season]
    level = sum(first[1:], first[0]) / season
    trend = (sum(second[1:], second[0]) / season - level) / season
    terms = first - level
    state = np.concatenate([[level, trend], terms])
    return np.repeat(state[:, None], n_sets, 1), level + trend + terms


def _fold(
    starts: np.ndarray, rests: list[np.ndarray], alpha: np.ndarray, beta: np.ndarray, gamma: np.ndarray,
    fitted: bool = False,
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """States after the values of each block, sums of squared errors and, if asked for, fitted values.

    ``starts`` is (state, block, set); the parameters are a value for each set, or for each block and
    set. Blocks may differ in length.
    """
    season = len(starts) - 2
    lengths = np.array([len(r) for r in rests], np.int64)
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    table = np.zeros((longest, len(rests)))
    for column, i in enumerate(order):
        table[: lengths[i], column] = rests[i]
    active = (lengths[:, None] > np.arange(longest)).sum(axis=0)
    shape = starts.shape[1:]
    alpha, beta, gamma = (np.broadcast_to(p, shape)[order if np.ndim(p) > 1 else slice(None)] for p in (alpha, beta, gamma))
    level, trend, *terms = (starts[i][order] for i in range(season + 2))
    sse = np.zeros(shape)
    kept = np.zeros((longest, *shape)) if fitted else None
    for i, n in enumerate(active):
        y, a, b, g = table[i, :n, None], alpha[:n], beta[:n], gamma[:n]
        oldest = terms[i % season]  # a ring: the newest term takes the place of the oldest
        s0, before = oldest[:n].copy(), level[:n].copy()
        now = a * (y - s0) + (1 - a) * (before + trend[:n])
        trend[:n] = b * (now - before) + (1 - b) * trend[:n]
        level[:n] = now
        oldest[:n] = g * (y - now) + (1 - g) * s0
        fit = now + trend[:n] + oldest[:n]
        sse[:n] += (y - fit) * (y - fit)
        if fitted:
            kept[i, :n] = fit
    # each ring is turned so that its oldest term comes first
    ring = np.stack(terms)
    turn = (np.arange(season)[:, None] + lengths[order]) % season
    ring = np.take_along_axis(ring, turn[:, :, None], axis=0)
    back = np.argsort(order)
    state = np.concatenate([level[None], trend[None], ring])[:, back]
    return state, sse[back], kept[:, back] if fitted else None


def _lists(rows: list[np.ndarray]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.float64()))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(begin, TOGETHER)


def _folded(
    batch: pa.RecordBatch, sets: np.ndarray, season: int, fitted: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, list[np.ndarray]]:
    """The fold of each block from its column x, or from zero without one; the first blocks as they begin."""
    n, m = batch.num_rows, sets.shape[-1]
    starts, rests, begun = np.zeros((season + 2, n, m)), [], []
    given = batch.column("x") if "x" in batch.schema.names else None
    for i, k in enumerate(batch.column("k").to_pylist()):
        ys = np.asarray(batch.column("ys")[i].values, np.float64)
        fits = np.zeros(0)
        if k == 0:
            starts[:, i], fits = _begin(ys, m, season)
            ys = ys[season:]
        elif given is not None:
            starts[:, i] = np.asarray(given[i].values, np.float64).reshape(season + 2, m)
        rests.append(ys)
        begun.append(fits)
    state, sse, kept = _fold(starts, rests, *sets, fitted=fitted)
    for i, fits in enumerate(begun):
        if len(fits):
            first = np.asarray(batch.column("ys")[i].values, np.float64)[:season]
            errors = (first - fits) * (first - fits)
            sse[i] += sum(errors[1:], errors[0])
    return state, sse, kept, begun


def _responses(batches: Iterator[pa.RecordBatch], sets: np.ndarray, season: int) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        state, *_ = _folded(batch, sets, season)
        yield pa.RecordBatch.from_arrays(
            [batch.column("series"), batch.column("k"), _lists([state[:, i].ravel() for i in range(batch.num_rows)])],
            names=["series", "k", "x"],
        )


def _errors(batches: Iterator[pa.RecordBatch], sets: np.ndarray, season: int) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        _, sse, *_ = _folded(batch, sets, season)
        yield pa.RecordBatch.from_arrays([batch.column("series"), _lists(list(sse))], names=["series", "sse"])


def _fits(batches: Iterator[pa.RecordBatch], sets: np.ndarray, season: int) -> Iterator[pa.RecordBatch]:
    """Fitted values and the last state by the set that each block names; x has that set alone."""
    for batch in _slices(batches):
        chosen = sets[:, batch.column("set_no").to_numpy()][:, :, None]
        state, _, kept, begun = _folded(batch, chosen, season, fitted=True)
        sizes = [len(batch.column("ys")[i]) - len(b) for i, b in enumerate(begun)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("series"), batch.column("k"),
             _lists([np.concatenate([b, kept[:n, i, 0]]) for i, (b, n) in enumerate(zip(begun, sizes))]),
             _lists([state[:, i, 0] for i in range(batch.num_rows)])],
            names=["series", "k", "fitted", "state"],
        )


# --- the states between blocks --------------------------------------------------------------


def step_matrix(alpha: float, beta: float, gamma: float, season: int) -> np.ndarray:
    """What a smoothing step does to the state, its value aside."""
    level = np.zeros(season + 2)
    level[:3] = 1 - alpha, 1 - alpha, -alpha
    out = np.zeros((season + 2, season + 2))
    out[0] = level
    out[1] = beta * level
    out[1, :2] += -beta, 1 - beta
    for i in range(season - 1):
        out[2 + i, 3 + i] = 1.0
    out[-1] = -gamma * level
    out[-1, 2] += 1 - gamma
    return out


def _composed(table: pa.Table, powers: np.ndarray, whole: bool, size: int) -> pa.Table:
    """One group of maps: the map of the group, or the states before its members.

    ``x`` is what a member leaves when it starts from zero, ``start`` the state before the group.
    """
    table = table.sort_by("k")
    sets, width = powers.shape[:2]
    ks = table.column("k").to_pylist()
    before = None if whole else table.column("start")[0]
    state = np.zeros((width, sets))
    if before is not None and before.is_valid:
        state = np.asarray(before.values, np.float64).reshape(width, sets)
    out = []
    for i, x in enumerate(table.column("x")):
        out.append(state.ravel())
        state = np.einsum("sij,js->is", powers, state) + np.asarray(x.values, np.float64).reshape(width, sets)
    if whole:
        ks, out = [ks[0] // size], [state.ravel()]
    series = [table.column("series")[0].as_py()] * len(ks)
    return pa.table([pa.array(series, pa.int64()), pa.array(ks, pa.int64()), _lists(out)], names=["series", "k", "x"])


_MAPS = "series long, k long, x array<double>"


def _befores(maps: DataFrame, powers: np.ndarray, size: int) -> DataFrame:
    """series, k and, as x, the state before each of the maps, which are staged."""
    group = F.floor(F.col("k") / size).alias("g")
    start = F.lit(None).cast("array<double>").alias("start")
    grouped = maps.select("series", "k", "x", group)
    if (maps.agg(F.max("k")).first()[0] or 0) >= size:
        upper = stage(
            grouped.groupBy("series", "g").applyInArrow(
                lambda table: _composed(table, powers, True, size), _MAPS
            ), "groups",
        )
        above = np.stack([np.linalg.matrix_power(p, size) for p in powers])
        starts = _befores(upper, above, size).select("series", F.col("k").alias("g"), F.col("x").alias("start"))
        grouped = grouped.join(starts, ["series", "g"], "left")
    else:
        grouped = grouped.withColumn("start", start)
    return stage(
        grouped.groupBy("series", "g").applyInArrow(
            lambda table: _composed(table, powers, False, size), _MAPS
        ), "prefixes",
    )


def _grid_of(params: Params) -> np.ndarray:
    """Rows alpha, beta, gamma; a column for each set."""
    return np.array(parameter_sets(params)).T


def _starts(blocks: DataFrame, params: Params, block: int, size: int = GROUP) -> DataFrame:
    """series, k and, as x, the states before the block by set, for all blocks of a series.

    The state before the first block is not used: that block begins with the averages.
    """
    season = params.season_length
    responses = functools.partial(_responses, sets=_grid_of(params), season=season)
    maps = stage(blocks.select("series", "k", "ys").mapInArrow(responses, _MAPS), "responses")
    powers = np.stack([np.linalg.matrix_power(step_matrix(*s, season), block) for s in parameter_sets(params)])
    return _befores(maps, powers, size)


def _fitted(points: DataFrame, keys: Sequence[str], params: Params, block: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of all series; blocks of those that are long enough, with the states before them by set."""
    if block < 2 * params.season_length:
        raise ValueError("a block must hold two seasons")
    blocks = _blocks(points, keys, block).withColumn("fits", F.col("length") >= 2 * params.season_length)
    parts = 4 * points.sparkSession.sparkContext.defaultParallelism
    spread = blocks.filter("fits").select("series", "k", "ys", "length").repartition(parts, "series", "k")
    # little data, much work
    starts = _starts(spread.select("series", "k", "ys"), params, block)
    return blocks, spread.join(starts, ["series", "k"])


def _scored(by_block: DataFrame, params: Params) -> DataFrame:
    errors = functools.partial(_errors, sets=_grid_of(params), season=params.season_length)
    found = by_block.select("series", "k", "ys", "x").mapInArrow(errors, "series long, sse array<double>")
    sums = found.select("series", F.posexplode("sse").alias("set_no", "sse")).groupBy("series", "set_no").agg(
        F.sum("sse").alias("sse")
    )
    lengths = by_block.filter("k = 0").select("series", F.col("length").alias("n"))
    aic = F.col("n") * F.ln(F.col("sse") / F.col("n") + F.lit(1e-10)) + PENALTY
    return sums.join(lengths, "series").select("series", "set_no", aic.alias("aic"))


def grid(
    points: DataFrame, keys: Sequence[str] = (), params: Params = Params(), block: int = BLOCK
) -> DataFrame:
    """AIC of every parameter set for every series, null where the series is too short."""
    blocks, by_block = _fitted(points, keys, params, block)
    sets = F.expr(f"posexplode({_sets(params)})").alias("set_no", "set")
    series = blocks.filter("k = 0").select(*keys, "series", sets).select(*keys, "series", "set_no", "set.*")
    return series.join(_scored(by_block, params), ["series", "set_no"], "left").select(*keys, "alpha", "beta", "gamma", "aic")


def forecast(
    points: DataFrame, keys: Sequence[str] = (), params: Params = Params(), block: int = BLOCK
) -> DataFrame:
    """keys, place n, t, actual and predicted of the history, then ``forecast_days`` places ahead.

    Predictions ahead are floored at zero and have no t.
    """
    season = params.season_length
    blocks, by_block = _fitted(points, keys, params, block)
    by_block = stage(by_block, "by-block")
    chosen = F.min_by("set_no", F.struct("aic", "set_no"))
    best = stage(_scored(by_block, params).groupBy("series").agg(chosen.alias("set_no")), "best")
    sets = len(parameter_sets(params))
    own = F.expr(f"transform(sequence(0, {season + 1}), i -> x[i * {sets} + set_no])")
    fits = functools.partial(_fits, sets=_grid_of(params), season=season)
    state = by_block.join(best, "series").select("series", "k", "ys", own.alias("x"), F.col("set_no").cast("long")).mapInArrow(
        fits, "series long, k long, fitted array<double>, state array<double>"
    )
    done = blocks.join(state, ["series", "k"], "left")
    past = F.expr(
        f"transform(ys, (y, i) -> named_struct('n', k * {block} + i, 't', ts[i], 'actual', y, "
        "'predicted', fitted[i], 'is_forecast', false))"
    )
    ahead = f"state[0] + h * state[1] + state[2 + (h - 1) % {season}]"
    future = F.expr(
        f"transform(if(k = last, sequence(1, {params.forecast_days}), cast(array() as array<int>)), "
        "h -> named_struct('n', length + h - 1, 't', element_at(ts, 1), 'actual', cast(null as double), "
        f"'predicted', if(({ahead}) is null, null, greatest(0D, {ahead})), 'is_forecast', true))"
    )
    rows = done.select(*keys, F.inline(F.concat(past, future)))
    return rows.withColumn("t", F.when(~F.col("is_forecast"), F.col("t")))
