"""Distributed quantiles and tiles against numpy and the built-in functions."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.operators import ranks
from tallymart.operators.ranks import weighted_quantiles, with_tiles

PROBABILITIES = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 1.0]


def _counts(spark, groups: dict[str, list[float]]):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "k string, value double")
    return frame.groupBy("k", "value").agg(F.count(F.lit(1)).alias("n"))


def _samples():
    rng = random.Random(7)
    return {
        "spread": [round(rng.lognormvariate(4, 1), 2) for _ in range(3000)],
        # A third of all rows holds one value.
        "hot": [1.0] * 1000 + [float(rng.randint(1, 40)) for _ in range(2000)],
        "signed": [rng.uniform(-50, 50) for _ in range(999)] + [0.0],
        "one": [4.25],
        "two": [1.0, 2.0],
        "same": [3.0] * 17,
        # Differences far below a hundredth, at both ends of the scale.
        "fine": [100 + i * 1e-8 for i in range(2500)],
        "tiny": [i * 1e-12 for i in range(2500)] + [5e8],
        "infinite": [float("-inf")] * 3 + [float(i) for i in range(2000)] + [float("inf")] * 5,
        "endless": [float("inf")] * 4 + [float("-inf")],
    }


@pytest.mark.parametrize("sorted_values", [ranks.SORTED_VALUES, 20])
def test_quantiles_equal_numpy_and_builtin(spark, sorted_values, monkeypatch):
    monkeypatch.setattr(ranks, "SORTED_VALUES", sorted_values)
    monkeypatch.setattr(ranks, "CELLS", 16)
    groups = _samples()
    counts = _counts(spark, groups).cache()
    wide = {r["k"]: r["quantiles"] for r in weighted_quantiles(counts, ["k"], PROBABILITIES).collect()}
    levels = F.array(*map(F.lit, PROBABILITIES))
    builtin = counts.groupBy("k").agg(F.percentile("value", levels, F.col("n")).alias("q"))
    assert {k: str(q) for k, q in wide.items()} == {r["k"]: str(r["q"]) for r in builtin.collect()}
    for name, values in groups.items():
        if math.inf in values:  # numpy takes differences of infinities
            continue
        assert wide[name] == pytest.approx(np.quantile(values, PROBABILITIES), rel=1e-12)


def test_decimals_that_are_one_double_end(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SORTED_VALUES", 5)
    rows = [("k", Decimal(10**17) + i) for i in range(12)] + [("n", Decimal(i)) for i in range(40)]
    counts = spark.createDataFrame(rows, "k string, value decimal(38,0)").withColumn("n", F.lit(1)).cache()
    found = ranks.select_ranks(counts, ["k"], lambda total: F.sequence(F.lit(0), (total - 1).cast("int")))
    got = {(r["k"], r["rank"]): r["value"] for r in found.collect()}
    assert got == {("k", i): Decimal(10**17) + i for i in range(12)} | {("n", i): Decimal(i) for i in range(40)}


def test_missing_numbers_come_last(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SORTED_VALUES", 3)
    counts = _counts(spark, {"some": [1.0, 2.0, 3.0, 4.0, math.nan], "all": [math.nan] * 3}).cache()
    found = ranks.select_ranks(counts, ["k"], lambda total: F.array(F.lit(0), (total - 1).cast("int")))
    got = {(r["k"], r["rank"]): str(r["value"]) for r in found.collect()}
    assert got == {("some", 0): "1.0", ("some", 4): "nan", ("all", 0): "nan", ("all", 2): "nan"}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-5, 30), min_size=1, max_size=60))
def test_distributed_quantiles_of_any_list(spark, values):
    counts = _counts(spark, {"x": values})
    row = weighted_quantiles(counts, ["k"], PROBABILITIES).first()
    assert row["quantiles"] == pytest.approx(np.quantile(values, PROBABILITIES))


def _tile_table(spark, n: int, seed: int):
    rng = random.Random(seed)
    gap = lambda v: None if rng.random() < 0.3 else v
    rows = [
        (f"C{i}", rng.choice([1, 1, 1, 2, 3]), round(rng.lognormvariate(3, 1), 2), rng.randint(0, 9),
         gap(rng.randint(-3, 3)), gap(7 + i * 1e-8), gap(Decimal(rng.randint(-500, 500)) / 100))
        for i in range(n)
    ]
    kinds = "id string, freq long, money double, days long, gaps long, fine double, exact decimal(12,2)"
    return spark.createDataFrame(rows, kinds)


@pytest.mark.parametrize(("n", "sorted_values"), [(1, 5), (6, 5), (30, 50_000), (1003, 50)])
def test_tiles_equal_ntile(spark, n, sorted_values, monkeypatch):
    monkeypatch.setattr(ranks, "SORTED_VALUES", sorted_values)
    table = _tile_table(spark, n, seed=n).cache()
    columns = {f"t_{c}": c for c in table.columns[1:]}
    spread = with_tiles(table, 5, columns, ["id"])
    tie = F.concat(F.md5("id"), F.lit("|"), F.col("id"))
    plain = table.withColumns(
        {t: F.ntile(5).over(Window.orderBy(c, tie)).cast("long") for t, c in columns.items()}
    )
    assert sorted(map(str, spread.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_tiles_of_one_single_value(spark):
    table = spark.range(1000).select(F.concat(F.lit("C"), "id").alias("id"), F.lit(1).alias("freq"))
    spread = with_tiles(table, 5, {"t": "freq"}, ["id"])
    sizes = {r["t"]: r["count"] for r in spread.groupBy("t").count().collect()}
    assert sizes == {t: 200 for t in range(1, 6)}
    assert "Window" not in spread.select("t")._jdf.queryExecution().executedPlan().toString().split(
        "BroadcastExchange"
    )[0]


def test_tiles_of_nulls_alone(spark):
    table = spark.range(7).select(F.col("id").cast("string"), F.lit(None).cast("double").alias("x"))
    assert sorted(r["t"] for r in with_tiles(table, 5, {"t": "x"}, ["id"]).collect()) == [1, 1, 2, 2, 3, 4, 5]
