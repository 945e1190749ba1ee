from __future__ import annotations

import math
import random

import pytest
from tests.test_forecast import P, _error_correction, _expected

from tallymart.operators import long_series

POINTS = "t long, y double"


def _values(n: int, seed: int = 1) -> list[float]:
    choose = random.Random(seed)
    return [500 + 0.01 * i + 40 * (i % 7 == 5) + 30 * math.sin(i / 50) + choose.random() for i in range(n)]


def _points(spark, ys):
    rows = list(enumerate(ys))
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, POINTS).repartition(5)


@pytest.mark.parametrize("n, block", [(14, 14), (15, 14), (43, 14), (700, 16), (700, 4096)])
def test_blocks_compose_to_the_fold(spark, n, block):
    ys = _values(n)
    table = long_series.forecast(_points(spark, ys), params=P, block=block).orderBy("n").collect()
    aic, predicted = _expected(ys, 10)
    assert [r["predicted"] for r in table] == pytest.approx(predicted, rel=1e-9)
    assert [r["actual"] for r in table] == ys + [None] * 10
    assert [r["t"] for r in table] == [*range(n), *[None] * 10]
    grid = long_series.grid(_points(spark, ys), params=P, block=block).collect()
    assert len(grid) == 48 and min(r["aic"] for r in grid) == pytest.approx(aic, rel=1e-9)
    for r in grid[::7]:
        aic, _ = _error_correction(ys, r["alpha"], r["beta"], r["gamma"], 1)
        assert r["aic"] == pytest.approx(aic, rel=1e-9)


def test_a_long_series_over_many_tasks(spark):
    few = P.__class__(**{**P.__dict__, "alphas": (0.2,), "betas": (0.01,), "gammas": (0.1, 0.3)})
    ys = _values(200_000)
    got = {r["gamma"]: r["aic"] for r in long_series.grid(_points(spark, ys), params=few).collect()}
    for gamma, aic in got.items():
        assert aic == pytest.approx(_error_correction(ys, 0.2, 0.01, gamma, 1)[0], rel=1e-9)


def test_series_by_key_null_keys_short_and_empty_ones(spark):
    a, b = _values(60, 4), _values(30, 5)
    rows = [("a", i, y) for i, y in enumerate(a)] + [(None, i, y) for i, y in enumerate(b)]
    rows += [("short", i, 1.0) for i in range(13)] + [("a", None, 1.0), ("a", 7, None), ("none", 1, None)]
    table = spark.createDataFrame(rows, "key string, " + POINTS)
    found = long_series.forecast(table, ["key"], P, block=14).orderBy("n").collect()
    for key, ys in (("a", a), (None, b)):
        assert [r["predicted"] for r in found if r["key"] == key] == pytest.approx(_expected(ys, 10)[1], rel=1e-9)
    assert [r["predicted"] for r in found if r["key"] == "short"] == [None] * 23
    assert {r["key"] for r in found} == {"a", None, "short"}
    aics = long_series.grid(table, ["key"], P, block=14).collect()
    assert len(aics) == 144 and {r["key"] for r in aics if r["aic"] is None} == {"short"}
    assert long_series.grid(table.limit(0), ["key"], P).collect() == []
    assert long_series.forecast(table.limit(0), params=P).collect() == []


def test_equal_times_are_in_order_of_values(spark):
    rows = [(i // 2, float(i * 37 % 101)) for i in range(80)]
    ys = [y for _, y in sorted(rows)]
    table = long_series.numbered(spark.createDataFrame(rows, POINTS), []).orderBy("n").collect()
    assert [r["y"] for r in table] == ys and [r["n"] for r in table] == list(range(80))
