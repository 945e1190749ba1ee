from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest

from tallymart import params as names
from tallymart.operators import clusters, rfm
from tallymart.params import Params
from tallymart.sources.orders import order_lines

P = Params(completed_status="F")


def _customers(make_orders, counts):
    start = dt.datetime(2025, 1, 1)
    return make_orders(*[
        {"customer_id": f"C{c}", "order_id": f"O{c}-{i}", "final_amount": c + 1,
         "order_date": start + dt.timedelta(days=c)}
        for c, n in enumerate(counts) for i in range(n)
    ])


def _expected_scores(values):
    bins = pd.qcut(pd.Series(values), 5, labels=False, duplicates="drop") + 1
    return [None if np.isnan(b) else int(b) for b in bins]


@pytest.mark.parametrize("counts", [
    [1] * 9 + [5], [1] * 10, [1, 2, 3], [1, 1, 2, 2, 3, 3, 4], [2, 7, 1, 1, 1, 3, 9, 4, 4, 5, 6],
])
def test_scores_equal_quantile_cut(make_orders, counts):
    params = Params(completed_status="F")
    rows = rfm.rfm_scores(_customers(make_orders, counts), params).collect()
    rows.sort(key=lambda r: int(r["customer_id"][1:]))
    assert [r["frequency_score"] for r in rows] == _expected_scores([r["frequency"] for r in rows])
    assert [r["monetary_score"] for r in rows] == _expected_scores([r["monetary"] for r in rows])
    recency = _expected_scores([r["recency"] for r in rows])
    assert [r["recency_score"] for r in rows] == [None if s is None else 6 - s for s in recency]


def test_first_type_is_that_of_the_earliest_order(make_orders):
    rows = make_orders(
        {"customer_type": "old", "order_date": dt.datetime(2025, 1, 2)},
        {"customer_type": "new", "order_date": dt.datetime(2025, 1, 1)},
        {"customer_type": None, "order_date": dt.datetime(2024, 1, 1)},
    )
    row = rfm.rfm(rows, P).first()
    assert (row["customer_type"], row["frequency"], row["recency"]) == ("new", 3, 0)


def test_naming_cascade(spark):
    profile = spark.createDataFrame(
        [(0, 10.0, 5.0, 900.0, 1), (1, 10.0, 50.0, 100.0, 1), (2, 900.0, 5.0, 100.0, 1),
         (3, 10.0, 1.0, 100.0, 1), (4, 10.0, 5.0, 100.0, 1)],
        "cluster int, avg_recency double, avg_frequency double, avg_monetary double, count long",
    )
    found = {r["cluster"]: r["segment"] for r in rfm.name_segments(profile).collect()}
    assert found == {
        0: names.SEGMENT_HIGH_VALUE, 1: names.SEGMENT_HIGH_FREQUENCY,
        2: names.SEGMENT_CHURN_RISK, 3: names.SEGMENT_LOW_ACTIVITY, 4: names.SEGMENT_POTENTIAL,
    }


def _cost(points, weights, labels):
    total = 0.0
    for label in set(labels):
        mask = labels == label
        centre = np.average(points[mask], axis=0, weights=weights[mask])
        total += (weights[mask] * ((points[mask] - centre) ** 2).sum(axis=1)).sum()
    return total


def test_clusters_are_complete_and_cheap(spark):
    lines = order_lines(spark, "/root/testdata/sf0.01",
                        ["order_id", "order_date", "order_status", "final_amount",
                         "customer_id", "customer_type"])
    clustered = rfm.cluster_customers(lines, P).cache()
    assert clustered.count() == rfm.rfm(lines, P).count()
    frame = clustered.select(*rfm.SCORES, "cluster").toPandas()
    assert sorted(frame["cluster"].unique()) == list(range(5))
    scores = frame[list(rfm.SCORES)].to_numpy(float)
    points = (scores - scores.mean(axis=0)) / scores.std(axis=0)
    weights = np.ones(len(points))
    cost = _cost(points, weights, frame["cluster"].to_numpy())
    # Moving any whole score combination to another cluster must not help much.
    labels = frame["cluster"].to_numpy()
    for combo in itertools.islice(sorted(set(map(tuple, scores))), 12):
        mask = (scores == combo).all(axis=1)
        for target in range(5):
            moved = labels.copy()
            moved[mask] = target
            if len(set(moved)) == 5:
                assert _cost(points, weights, moved) >= cost * 0.98
    segments = rfm.customer_segments(clustered)
    summary = rfm.segment_summary(segments).collect()
    assert sum(r["customer_count"] for r in summary) == clustered.count()
    values = [r["avg_lifetime_value"] for r in summary]
    assert values == sorted(values, reverse=True)


@pytest.mark.parametrize("seed", range(4))
def test_kmeans_equals_a_plain_one(spark, seed):
    """The same seeding and steps in plain Python, and no worse than twenty random starts of k-means++."""
    draw = np.random.default_rng(seed)
    grid = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6) if draw.random() < 0.5]
    weights = draw.integers(1, 50, len(grid))
    rows = [(*map(int, p), int(w)) for p, w in zip(grid, weights)]
    table = spark.createDataFrame(rows, "a int, b int, c int, weight int").selectExpr(
        "cast(a as bigint) a", "cast(b as bigint) b", "cast(c as bigint) c", "cast(weight as bigint) weight"
    )
    found = clusters.weighted_kmeans(table, ["a", "b", "c"], 5)
    got = {(r["a"], r["b"], r["c"]): r["cluster"] for r in found.collect()}
    assert set(got) == set(grid) and set(got.values()) == set(range(5))
    points = np.array(grid, float)
    mean = np.average(points, axis=0, weights=weights)
    scale = np.sqrt(np.average((points - mean) ** 2, axis=0, weights=weights))
    labels = np.array([got[p] for p in grid])
    centres = np.array([np.average(points[labels == k], axis=0, weights=weights[labels == k]) for k in range(5)])
    far = (((points[:, None] - centres) / scale) ** 2).sum(axis=2)
    assert (far.argmin(axis=1) == labels).all()  # settled
    assert sorted(map(tuple, centres)) == list(map(tuple, centres))  # numbered by centre

    def random_start() -> float:
        chosen = points[draw.choice(len(points), 5, replace=False, p=weights / weights.sum())]
        for _ in range(60):
            own = (((points[:, None] - chosen) / scale) ** 2).sum(axis=2).argmin(axis=1)
            chosen = np.array([
                np.average(points[own == k], axis=0, weights=weights[own == k]) if (own == k).any() else chosen[k]
                for k in range(5)
            ])
        return (weights * (((points[:, None] - chosen) / scale) ** 2).sum(axis=2).min(axis=1)).sum()

    cost = (weights * far.min(axis=1)).sum()
    assert cost <= 1.05 * min(random_start() for _ in range(20))


def test_kmeans_of_few_or_equal_points(spark):
    one = spark.createDataFrame([(3, 3, 9)], "a long, b long, weight long")
    assert [tuple(r) for r in clusters.weighted_kmeans(one, ["a", "b"], 5).collect()] == [(3, 3, 0)]
    none = one.filter("a > 5")
    assert clusters.weighted_kmeans(none, ["a", "b"], 5).collect() == []


def test_few_score_combinations_are_their_own_clusters(make_orders):
    clustered = rfm.cluster_customers(_customers(make_orders, [1] * 3), P)
    assert sorted(r["cluster"] for r in clustered.collect()) == [0, 1, 2]
