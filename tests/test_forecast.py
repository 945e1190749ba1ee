from __future__ import annotations

import datetime as dt
import math
from collections import deque
from statistics import mean

import pytest

from tallymart.operators import forecast
from tallymart.params import Params

P = Params(completed_status="F", forecast_days=10)


def _orders(make_orders, ys, **extra):
    start = dt.datetime(2025, 1, 1, 12)
    return make_orders(*[
        {"order_date": start + dt.timedelta(days=i), "final_amount": round(y, 2), **extra}
        for i, y in enumerate(ys)
    ])


def _error_correction(y, alpha, beta, gamma, horizon):
    """The same smoothing in its error-correction form: every component moves by a share of the
    one-step error, which is algebraically equal but computed along another path."""
    first, second = y[:7], y[7:14]
    base, slope = mean(first), (mean(second) - mean(first)) / 7
    cycle = deque(v - base for v in first)
    fits = [slope + v for v in first]
    for observed in y[7:]:
        effect = cycle.popleft()
        error = observed - (base + slope + effect)
        base += slope + alpha * error
        slope += alpha * beta * error
        cycle.append(effect + gamma * (1 - alpha) * error)
        fits.append(base + slope + cycle[-1])
    squares = sum((a - b) ** 2 for a, b in zip(y, fits))
    aic = len(y) * math.log(squares / len(y) + 1e-10) + 6
    ahead = [max(0.0, base + h * slope + cycle[(h - 1) % 7]) for h in range(1, horizon + 1)]
    return aic, fits + ahead


def _expected(y, horizon):
    runs = [
        _error_correction(y, a, b, g, horizon) for a in P.alphas for b in P.betas for g in P.gammas
    ]
    return min(runs, key=lambda run: run[0])


@pytest.mark.parametrize("days", [14, 15, 40])
def test_forecast_equals_error_correction(make_orders, days):
    ys = [100 + 3 * i + 25 * (i % 7 == 5) + (i * i) % 11 for i in range(days)]
    table = forecast.sales_forecast(_orders(make_orders, ys), params=P).collect()
    aic, predicted = _expected([float(y) for y in ys], 10)
    assert [r["predicted"] for r in table] == pytest.approx(predicted, rel=1e-9)
    assert [r["is_forecast"] for r in table] == [False] * days + [True] * 10
    assert table[-1]["ds"] == dt.date(2025, 1, 1) + dt.timedelta(days=days + 9)
    grid = forecast.hw_grid(_orders(make_orders, ys), params=P).collect()
    assert len(grid) == 48 and min(r["aic"] for r in grid) == pytest.approx(aic, rel=1e-9)


def test_short_series_has_no_prediction(make_orders):
    table = forecast.sales_forecast(_orders(make_orders, range(1, 14)), params=P).collect()
    assert len(table) == 23 and all(r["predicted"] is None for r in table)


def test_falling_series_is_floored_at_zero(make_orders):
    ys = [300 - 10 * i for i in range(28)]
    table = forecast.sales_forecast(_orders(make_orders, ys), params=P).collect()
    assert min(r["predicted"] for r in table if r["is_forecast"]) == 0.0


def test_periodic_series_repeats(make_orders):
    ys = [10 * (i % 7 + 1) for i in range(35)]
    table = forecast.sales_forecast(_orders(make_orders, ys), params=P).collect()
    ahead = [r["predicted"] for r in table if r["is_forecast"]]
    assert ahead == pytest.approx([10 * (i % 7 + 1) for i in range(35, 45)], abs=1e-6)


def test_series_by_key_equal_series_alone(make_orders):
    a = _orders(make_orders, [50 + i % 7 for i in range(20)], category="A")
    b = _orders(make_orders, [90 - i for i in range(20)], category="B")
    both = forecast.sales_forecast(a.unionByName(b), ["category"], P)
    alone = forecast.sales_forecast(b, params=P)
    got = both.filter("category = 'B'").drop("category").collect()
    assert got == alone.collect()
    assert forecast.forecast_total(alone).first()["forecast_days"] == 10
