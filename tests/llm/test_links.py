from __future__ import annotations

import random

import numpy as np
import pytest
from tests.conftest import SF_DIR
from tests.llm import brute

from tallymart.llm import embeddings, graph, ngram_join


def order(row: tuple) -> tuple:
    return tuple((x is None, x or 0) for x in row)


def joined(docs) -> list[tuple]:
    rows = ngram_join.join(docs).select("doc_id", "class_id", "n_links", "component_id").collect()
    return sorted(map(tuple, rows), key=order)


@pytest.fixture(scope="module")
def crowd(spark):
    """A large group of near copies of one text, some near to others, beside plain texts."""
    choose = random.Random(11)
    base = [f"w{choose.randrange(999)}" for _ in range(150)]
    texts = []
    for i in range(260):
        own = list(base)
        for _ in range(choose.choice([0, 1, 2, 3])):
            own[choose.randrange(len(own))] = f"z{choose.randrange(999)}"
        texts.append((i, " ".join(own)))
    texts += [(1000 + i, " ".join(f"v{choose.randrange(999)}" for _ in range(60))) for i in range(40)]
    return spark.createDataFrame(texts, "doc_id long, text string"), texts


@pytest.mark.parametrize("few", [ngram_join.CROWD, 8])
def test_all_near_copies_link(spark, crowd, odd_docs, odd_texts, few, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", few)
    monkeypatch.setattr(ngram_join, "BLOCK", 50)
    monkeypatch.setattr(ngram_join, "COLUMNS", 100)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    given = docs, [(r["doc_id"], r["text"]) for r in docs.collect()]
    for table, texts in (given, crowd, (odd_docs, odd_texts)):
        assert joined(table) == sorted(brute.jaccard_classes(texts), key=order)


def test_one_of_each_group_stays(odd_docs, odd_texts):
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.select("doc_id", "text").collect()
    bare = [t for t in odd_texts if not brute.words(t[1])]
    firsts = {c for _, _, _, c in brute.jaccard_classes([t for t in odd_texts if brute.words(t[1])])}
    assert sorted((r["doc_id"] for r in rows if brute.words(r["text"])), key=str) == sorted(firsts, key=str)
    assert len(rows) == len(firsts) + len(bare)


def test_no_documents_no_links(no_docs):
    assert joined(no_docs) == [] and ngram_join.keep_one(no_docs).collect() == []


def test_prefixes_shorten_until_the_target():
    depth = ngram_join.depth_for(0.8)
    chance = lambda d: 1 - (1 - 0.8**d) ** ngram_join.TREES
    assert chance(depth) >= ngram_join.TARGET > chance(depth + 1)
    assert ngram_join.depth_for(0.99) == ngram_join.DEEPEST


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    choose = random.Random(seed)
    edges = [(choose.randrange(300), choose.randrange(300)) for _ in range(150)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a chain of ascending ids
    found = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    names = sorted({x for e in real for x in e})
    at = {x: i for i, x in enumerate(names)}
    roots = brute.groups(len(names), [(at[a], at[b]) for a, b in real])
    assert sorted(found) == names
    assert len({(found[x], roots[at[x]]) for x in names}) == len(set(roots)) == len(set(found.values()))


def exact_links(rows: list[tuple]) -> list[tuple]:
    usable = [
        label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    links = []
    for a in range(len(rows)):
        for b in range(a):
            if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= embeddings.SIMILAR:
                    links.append((a, b))
    roots = brute.groups(len(rows), links)
    least: dict = {}
    for (i, _, _), root in zip(rows, roots):
        least[root] = min(x for x in (i, least.get(root)) if x is not None) if i is not None else least.get(root)
    degree = [sum(k in link for link in links) for k in range(len(rows))]
    return [(i, n, least[root]) for (i, _, _), n, root in zip(rows, degree, roots)]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    out = []
    for group in range(60):
        centre = rng.standard_normal(32)
        for _ in range(rng.integers(1, 6)):
            v = centre + rng.standard_normal(32) * 0.08
            out.append(((v / np.linalg.norm(v)).astype(np.float32).tolist(), int(group % 3)))
    out += [(out[5][0], out[5][1])] * 4 + [([2 * x for x in out[7][0]], out[7][1]), (out[9][0], 99)]
    rows = [(i, v, label) for i, (v, label) in enumerate(out)]
    same = rows[3][1]
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] * 32, [None] + same[1:], same[:31]]
    rows += [(900 + i, v, 0) for i, v in enumerate(odd)] + [(950, same, None), (3, same, rows[3][2])]
    return rows


def test_vectors_link_at_the_threshold(spark, vectors):
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(vectors, schema).selectExpr("*", "1 as row", "2 as key", "3 as code")
    got = sorted((tuple(r) for r in embeddings.link(table).collect()), key=order)
    wanted = sorted(exact_links(vectors), key=order)
    assert [g[0] for g in got] == [w[0] for w in wanted]
    assert all(g[1] <= w[1] for g, w in zip(got, wanted))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in wanted) > 0
    assert all(g[3] == (g[0] == g[2]) for g in got)
    if sum(g[1] for g in got) == sum(w[1] for w in wanted):
        assert [g[:3] for g in got] == wanted
    assert embeddings.link(table.limit(0)).collect() == []


def test_codes_are_balanced_and_near_for_near_vectors():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 48)) * np.linspace(3, 0.3, 48)
    quantiser = embeddings.fit(x)
    codes = quantiser.code(x)
    bits = (codes.view(np.uint64)[:, None] >> np.arange(48, dtype=np.uint64)) & np.uint64(1)
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.1
    assert np.allclose(quantiser.rotation.T @ quantiser.rotation, np.eye(48))
    near = quantiser.code(x + rng.standard_normal(x.shape) * 0.02)
    apart = lambda a, b: np.mean([bin(int(i) ^ int(j)).count("1") for i, j in zip(a.view(np.uint64), b.view(np.uint64))])
    assert apart(codes, near) < 3 < 18 < apart(codes, np.roll(codes, 1))
