from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF_DIR
from tests.llm import brute

from tallymart.llm import language, mixing, quality_rules, quality_trees

LARGER = SF_DIR.replace("0.001", "0.01")
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def given(spark):
    return tuple(spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def share_in_order(labels: np.ndarray, scores: np.ndarray) -> float:
    """Of pairs of a good and a poor row, how many are in order."""
    good, poor = scores[labels == 1], scores[labels == 0]
    return float((good[:, None] > poor[None, :]).mean())


def test_base_counts(odd_docs, odd_texts, given):
    rows = quality_rules.quality_rules(odd_docs, given[1]).collect()
    got = sorted((tuple(r)[:7] for r in rows), key=str)
    wanted = []
    for doc_id, text in odd_texts:
        counts = brute.base_counts(text)
        wanted.append((doc_id, *counts, counts[0] < 20 or 100 * counts[4] > 30 * counts[0]))
    assert got == sorted(wanted, key=str)
    assert not any(r["kept"] for r in rows if r["base_failed"])
    assert all(r["kept"] == (r["probability"] >= quality_rules.KEEP_AT) for r in rows if not r["base_failed"])


def test_regression_tells_good_from_poor(given):
    docs, labels = given
    # train on half of the labels, measure on the others
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = quality_rules.quality_rules(docs, labels.filter(half)).join(labels.filter(~half), "doc_id").toPandas()
    assert share_in_order(found.quality.values, found.probability.values) > 0.95
    sound = found[(found.quality == 1) & ~found.base_failed]
    assert sound.kept.mean() > 0.99
    assert (found[(found.quality == 0)].kept).mean() < 0.2


def test_calibration_gives_shares():
    rng = np.random.default_rng(2)
    margin = rng.standard_normal(4000) * 3
    labels = (rng.random(4000) < quality_rules.sigmoid(0.5 * margin - 1)).astype(float)
    slope, offset = quality_rules.platt(margin, labels)
    assert slope == pytest.approx(0.5, abs=0.06) and offset == pytest.approx(-1, abs=0.12)


@pytest.mark.parametrize("rows", [[], [(7, 1, 0)], [(7, None, None)]])
def test_models_without_two_kinds_of_labels(spark, odd_docs, no_docs, rows):
    labels = spark.createDataFrame(rows, LABELS)
    found = quality_rules.quality_rules(odd_docs, labels).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in found)
    assert {0 <= r["score"] <= 1 for r in quality_trees.quality_scores(odd_docs, labels).collect()} == {True}
    assert quality_rules.quality_rules(no_docs, labels).collect() == []
    assert quality_trees.quality_scores(no_docs, labels).collect() == []


def test_trees_on_held_out_documents(given):
    docs, labels = given
    found = quality_trees.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert found.held_out.tolist() == [is_held_out(i) for i in found.doc_id]
    assert ((found.score >= 0.3).astype(int) == found.predicted).all()
    held = found[found.held_out]
    assert share_in_order(held.quality.values, held.score.values) > 0.95
    assert held[held.quality == 1].predicted.mean() > 0.97


def test_trees_learn_what_a_line_cannot():
    rng = np.random.default_rng(6)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality_trees.fit(x[:3000], y[:3000])
    score = trees.score(x[3000:])
    assert ((score > 0.5) == y[3000:]).mean() > 0.97
    # walking all trees at once is walking them one by one
    inner = trees.feature.shape[1]
    for row, got in zip(x[3000:3020], score):
        total = trees.start
        for t in range(len(trees.feature)):
            node = 0
            while node < inner:
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            total += trees.leaf[t, node - inner]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics_of_odd_texts_are_finite(odd_texts):
    texts = [t for _, t in odd_texts]
    x = quality_trees.statistics(quality_trees.Words(pa.array(texts, pa.string())), texts)
    assert x.shape == (len(texts), len(quality_trees.STATISTICS)) and np.isfinite(x).all()
    at = quality_trees.STATISTICS.index
    spin = x[[i for i, _ in odd_texts].index(16)]
    assert spin[at("distinct")] == pytest.approx(1 / 900) and spin[at("repeated")] == 1
    assert spin[at("same_as_last")] == pytest.approx(899 / 900)


def test_languages_of_held_out_documents(given):
    docs, _ = given
    found = language.predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert found.held_out.tolist() == [is_held_out(i) for i in found.doc_id]
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()


def test_languages_of_odd_texts(odd_docs, no_docs, odd_texts):
    rows = language.predict_language(odd_docs).collect()
    assert len(rows) == len(odd_texts)
    without = {1, 2, 3}
    for r in rows:
        if r["doc_id"] in without:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "xx")
    unlearnt = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.predict_language(unlearnt).collect()} == {"und"}
    assert language.predict_language(no_docs).collect() == []


def test_the_folded_matrix_is_the_kernel_regression():
    texts = [f"{a} {b} words {a * 2}" for a in ("abc", "bcd", "xyz", "zxy") for b in ("one", "two", "six")]
    names = ["p"] * 6 + ["q"] * 6
    present = language.presence(pa.array(texts))
    model = language.fit(present, names, landmarks=12)
    rows = language.unit(present).astype(float)
    kernel = rows @ rows.T
    target = np.where(np.array(names)[:, None] == np.array(["p", "q"]), 1.0, -1.0)
    # with every text a landmark, ridge in the Nyström space is kernel ridge on centred features
    centre = np.eye(12) - 1 / 12
    dual = np.linalg.solve(centre @ kernel @ centre + language.RIDGE * np.eye(12), centre @ target)
    wanted = (kernel - kernel.mean(axis=0)) @ centre @ dual + target.mean(axis=0)
    got = rows @ model.weights.astype(float) + model.offset
    assert np.allclose(got, wanted, atol=1e-2)


def test_rates_meet_the_targets(given):
    docs, labels = given
    mixed = mixing.mix(docs, mixing.label_domains(labels), carry=("doc_id", "text")).toPandas()
    p = np.array(mixed._p.tolist())
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all() and (mixed.rate >= 0).all()
    totals = (mixed.n_tokens.values * mixed.rate.values) @ p
    assert totals / mixed.n_tokens.sum() == pytest.approx(list(mixing.TARGETS.values()), abs=1e-4)
    assert [len(brute.words(d["text"])) for d in mixed._document] == mixed.n_tokens.tolist()
    # the posteriors rank the labelled documents
    good = {r["doc_id"]: r["quality"] == 1 and r["toxic"] == 0 for r in labels.collect()}
    known = [(good[d["doc_id"]], x[0]) for d, x in zip(mixed._document, p) if d["doc_id"] in good]
    assert share_in_order(np.array([int(g) for g, _ in known]), np.array([x for _, x in known])) > 0.9


def test_rates_solve_the_bounded_least_squares(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    n = rng.integers(1, 500, 300)
    table = spark.createDataFrame([(int(a), x.tolist()) for a, x in zip(n, p)], "n_tokens long, _p array<double>")
    wanted = {"a": 0.6, "b": 0.3, "c": 0.1}
    steps = mixing.fit_rates(table, wanted, None, float("inf"))
    rate = np.ones(300)
    for step in steps:
        rate = np.maximum(0, rate - p @ step)
    got = np.array([r[0] for r in table.select(mixing._rate(steps, 3, float("inf"))).collect()])
    assert np.allclose(got, rate)
    assert (n * rate) @ p / n.sum() == pytest.approx([0.6, 0.3, 0.1], abs=1e-5)
    bounded = mixing.fit_rates(table, wanted, "a", 1.0)
    rate = np.array([r[0] for r in table.select(mixing._rate(bounded, 3, 1.0)).collect()])
    assert rate.max() <= 1 and rate.min() >= 0
    goal = np.array([0.6, 0.3, 0.1]) * (n @ p)[0] / 0.6
    before, after = n @ p - goal, (n * rate) @ p - goal
    assert after @ after < 0.2 * (before @ before)


def least_error(p, n, goal, most) -> float:
    """The least squared error of bounded rates, by accelerated projected gradient steps."""
    a, top = n[:, None] * p, np.linalg.eigvalsh((p * n[:, None]).T @ p).max()
    rate = ahead = np.full(len(n), min(1.0, most))
    speed = 1.0
    for _ in range(20_000):
        moved = np.clip(ahead - p @ (ahead @ a - goal) / top, 0, most)
        if (n * (ahead - moved)) @ (moved - rate) > 0:
            speed = 1.0
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead, rate, speed = moved + (speed - 1) / faster * (moved - rate), moved, faster
    return float(np.square(rate @ a - goal).sum())


@pytest.mark.parametrize("seed, most", [(1, 1.0), (3, 1.0), (4, 2.0), (5, 0.5)])
def test_rates_reach_the_least_error(spark, seed, most):
    rng = np.random.default_rng(seed)
    p, n = rng.dirichlet([1.2, 0.4, 0.13], 300), rng.integers(1, 500, 300)
    table = spark.createDataFrame([(int(a), x.tolist()) for a, x in zip(n, p)], "n_tokens long, _p array<double>")
    wanted = {"a": 0.6, "b": 0.3, "c": 0.1} if seed < 3 else {"a": 0.9, "b": 0.08, "c": 0.02}
    hold = "a" if most == 1.0 else None
    steps = mixing.fit_rates(table, wanted, hold, most)
    rate = np.array([r[0] for r in table.select(mixing._rate(steps, 3, most)).collect()])
    totals, share = min(1.0, most) * (n @ p), np.array(list(wanted.values()))
    goal = share * (totals[0] / share[0] if hold else totals.sum())
    least = least_error(p, n, goal, most) / totals.sum() ** 2
    got = np.square((n * rate) @ p - goal).sum() / totals.sum() ** 2
    assert rate.min() >= 0 and rate.max() <= most and got <= least + 1e-8


def test_held_documents_keep_their_rate(given):
    docs, labels = given
    mixed = mixing.mix(docs, mixing.label_domains(labels), hold="good", most=1.0, carry=("doc_id",)).toPandas()
    p, n, rate = np.array(mixed._p.tolist()), mixed.n_tokens.values, mixed.rate.values
    held = p[:, 0] >= p.max(axis=1)
    assert held.any() and (rate[held] == 1).all() and rate[~held].min() < 1
    share = np.array(list(mixing.TARGETS.values()))
    goal = share * (n @ p)[0] / share[0]
    rest = goal - n[held] @ p[held]
    least = least_error(p[~held], n[~held], rest, 1.0) / n.sum() ** 2
    assert np.square((n * rate) @ p - goal).sum() / n.sum() ** 2 <= least + 1e-8


def test_held_out_toxic_documents_are_told(spark):
    labels = mixing.label_domains(spark.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/labels.parquet"))
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/documents.parquet").join(labels, "doc_id", "left_semi")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    domains = list(mixing.TARGETS)
    found = mixing.domain_probabilities(docs, labels.filter(~held_out), domains, carry=("doc_id",))
    rows = found.select("_document.doc_id", "_p").filter(held_out).join(labels, "doc_id").toPandas()
    p = np.array(rows._p.tolist())
    right = p.argmax(axis=1) == rows.domain.map(domains.index).values
    recall = {d: right[(rows.domain == d).values].mean() for d in domains}
    assert recall["good"] > 0.95 and recall["poor"] > 0.6 and recall["toxic"] > 0.8
    toxic, good = (p[(rows.domain == d).values, domains.index("toxic")] for d in ("toxic", "good"))
    assert (toxic[:, None] > good[None, :]).mean() > 0.9


def test_mixing_odd_tables(spark, odd_docs, no_docs, odd_texts, given):
    labels = mixing.label_domains(given[1])
    mixed = mixing.mix(odd_docs, labels).collect()
    assert len(mixed) == len(odd_texts)
    assert all(r["n_tokens"] == len(brute.words(r["_document"]["text"])) for r in mixed)
    assert mixing.mix(no_docs, labels).collect() == []
    unlabelled = mixing.mix(odd_docs, labels.limit(0)).collect()
    assert all(x == pytest.approx(1 / 3) for r in unlabelled for x in r["_p"])
    with pytest.raises(ValueError, match="target above 0"):
        mixing.mix(odd_docs, labels, {"good": 0.0})


def test_copies_follow_the_rates(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'x' as text", "id % 3 as rate3")
    mixed = docs.select(F.struct("doc_id", "text").alias("_document"), (F.col("rate3") * 0.75).alias("rate"))
    found = mixing.repeat_by_rate(mixed).groupBy("doc_id").count().toPandas()
    by = found.groupby(found.doc_id % 3)["count"].sum() / (4000 / 3)
    assert 0 not in by and by[1] == pytest.approx(0.75, abs=0.05) and by[2] == pytest.approx(1.5, abs=0.05)
