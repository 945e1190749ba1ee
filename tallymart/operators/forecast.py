"""Additive Holt-Winters forecast of daily revenue.

Each series is one array, bounded by the calendar (a value per day with sales). A parameter set
is a row, and the recursion is a fold over the array with the built-in ``aggregate`` function,
so the whole grid runs in the JVM, spread over the cluster by series and parameter set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.numeric import round_half_up
from tallymart.operators.trends import daily_totals, trend_ma7
from tallymart.params import Params
from tallymart.sources.staging import stage

PENALTY = 2 * 3  # AIC term for three smoothing parameters


def _state(level: str, trend: str, seasonal: list[str], sse: str, fitted: str | None) -> str:
    """Accumulator of the fold. Seasonal terms form a queue of plain fields, s0 the oldest."""
    fields = {"level": level, "trend": trend}
    fields |= {f"s{i}": term for i, term in enumerate(seasonal)}
    fields["sse"] = sse
    if fitted:
        fields["fitted"] = fitted
    return "named_struct(" + ", ".join(f"'{name}', {e}" for name, e in fields.items()) + ")"


def _initial(season: int, keep_fitted: bool) -> str:
    """State before the first update: averages of the first two seasons."""
    first = [f"ys[{i}]" for i in range(season)]
    second = [f"ys[{i}]" for i in range(season, 2 * season)]
    level = f"(({' + '.join(first)}) / {season})"
    trend = f"((({' + '.join(second)}) / {season} - {level}) / {season})"
    seasonal = [f"({v} - {level})" for v in first]
    fitted = [f"({level} + {trend} + {term})" for term in seasonal]
    sse = " + ".join(f"({v} - {fit}) * ({v} - {fit})" for v, fit in zip(first, fitted))
    kept = f"array({', '.join(fitted)})" if keep_fitted else None
    return _state(level, trend, seasonal, sse, kept)


def _update(season: int, keep_fitted: bool) -> str:
    """State ``s`` after value ``y``. Arithmetic is repeated where a lambda cannot name an
    intermediate value; that is cheaper than wrapping it."""
    level = "(alpha * (y - s.s0) + (1 - alpha) * (s.level + s.trend))"
    trend = f"(beta * ({level} - s.level) + (1 - beta) * s.trend)"
    newest = f"(gamma * (y - {level}) + (1 - gamma) * s.s0)"
    fit = f"({level} + {trend} + {newest})"
    queue = [f"s.s{i}" for i in range(1, season)] + [newest]
    sse = f"s.sse + (y - {fit}) * (y - {fit})"
    kept = f"concat(s.fitted, array({fit}))" if keep_fitted else None
    return _state(level, trend, queue, sse, kept)


def _fit(params: Params, keep_fitted: bool) -> Column:
    """Final state of the recursion over ``ys``; null for a series shorter than two seasons.

    Expects the columns ys, alpha, beta and gamma.
    """
    season = params.season_length
    rest = f"slice(ys, {season + 1}, size(ys) - {season})"
    return F.expr(
        f"CASE WHEN size(ys) >= {2 * season} THEN "
        f"aggregate({rest}, {_initial(season, keep_fitted)}, (s, y) -> {_update(season, keep_fitted)}) END"
    )


def _series(df: DataFrame, keys: Sequence[str], params: Params) -> DataFrame:
    """One row per series: its days and values as arrays in date order."""
    day = F.struct(F.col("date").alias("ds"), F.col("total").cast("double").alias("y"))
    return (
        daily_totals(df, tuple(keys), params)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(day)).alias("points"))
        .filter(F.size("points") > 0)
        .select(*keys, F.col("points.ds").alias("days"), F.col("points.y").alias("ys"))
    )


def _sets(params: Params) -> str:
    """Array of the parameter sets, as SQL."""
    return "array(" + ", ".join(
        f"named_struct('alpha', {a}D, 'beta', {b}D, 'gamma', {g}D)" for a, b, g in parameter_sets(params)
    ) + ")"


def parameter_sets(params: Params) -> list[tuple[float, float, float]]:
    """The grid, in order of set_no."""
    return [(a, b, g) for a in params.alphas for b in params.betas for g in params.gammas]


def _grid(series: DataFrame, keys: Sequence[str], params: Params) -> DataFrame:
    # The work is in the folds, not in the bytes: a fold takes far longer than moving its array, so
    # every series and parameter set is dealt out on its own, and the number of partitions is stated.
    numbered = F.expr(f"posexplode({_sets(params)})").alias("set_no", "set")
    rows = series.select(*keys, "ys", numbered).select(*keys, "ys", "set_no", "set.*")
    return rows.repartition(4 * series.sparkSession.sparkContext.defaultParallelism, *keys, "set_no")


def _scored_grid(series: DataFrame, keys: Sequence[str], params: Params) -> DataFrame:
    n = F.size("ys")
    return (
        _grid(series, keys, params)
        .withColumn("sse", _fit(params, keep_fitted=False)["sse"])
        .withColumn("aic", n * F.ln(F.col("sse") / n + F.lit(1e-10)) + PENALTY)
        .select(*keys, "set_no", "alpha", "beta", "gamma", "aic")
    )


def hw_grid(df: DataFrame, keys: Sequence[str] = (), params: Params = Params()) -> DataFrame:
    """AIC of every smoothing parameter set; null where the series is too short."""
    series = stage(_series(df, keys, params), "series")
    return _scored_grid(series, keys, params).drop("set_no")


def sales_forecast(df: DataFrame, keys: Sequence[str] = (), params: Params = Params()) -> DataFrame:
    """Fitted values of the history followed by ``forecast_days`` predicted days per series.

    Days without sales are not filled in: the season follows the row number. Predictions are
    floored at zero. A series that is too short gets null predictions.
    """
    keys = list(keys)
    season = params.season_length
    series = stage(_series(df, keys, params), "series")
    chosen = F.min_by(
        F.struct("alpha", "beta", "gamma"), F.struct(F.col("aic"), F.col("set_no"))
    )
    best = _scored_grid(series, keys, params).groupBy(*keys).agg(chosen.alias("best"))
    together = series.join(best, keys, "left") if keys else series.crossJoin(F.broadcast(best))
    fitted = together.select(*keys, "days", "ys", "best.*")
    if keys:
        # Stated for the same reason as above: a few long folds are little data but much work.
        fitted = fitted.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)
    fitted = fitted.withColumn("state", _fit(params, keep_fitted=True))

    queue = ", ".join(f"state.s{i}" for i in range(season))
    ahead = f"state.level + h * state.trend + array({queue})[(h - 1) % {season}]"
    past = F.expr(
        "transform(ys, (y, i) -> named_struct('ds', days[i], 'actual', y, "
        "'predicted', state.fitted[i], 'is_forecast', false))"
    )
    future = F.expr(
        f"transform(sequence(1, {params.forecast_days}), h -> named_struct("
        "'ds', date_add(array_max(days), h), 'actual', cast(null as double), "
        f"'predicted', if(({ahead}) is null, null, greatest(0D, {ahead})), 'is_forecast', true))"
    )
    # Rows leave each series in date order; a global sort would run the folds a second time to
    # sample its ranges.
    return fitted.select(*keys, F.inline(F.concat(past, future)))


def forecast_total(forecast: DataFrame) -> DataFrame:
    """Sum of the predicted future days."""
    return forecast.filter("is_forecast").agg(
        round_half_up(F.sum("predicted"), 2).alias("forecast_total"),
        F.count("predicted").alias("forecast_days"),
    )


def forecast_overlay(df: DataFrame, forecast: DataFrame, params: Params = Params()) -> DataFrame:
    """Daily revenue with its seven-day average, continued by the predicted days."""
    history = trend_ma7(df, params=params)
    future = forecast.filter("is_forecast").select(F.col("ds").alias("date"), "predicted")
    return history.unionByName(future, allowMissingColumns=True).orderBy("date")
