from __future__ import annotations

import shutil

import pytest
from tests.conftest import SF_DIR
from tests.llm import brute

import __spark_entry__ as registry
import corpus_pipeline
from tallymart.llm import queries


@pytest.fixture(scope="module")
def stages(spark):
    """The rows of documents and of every stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = {"documents": docs}
    for name, apply in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(apply(spark, docs, SF_DIR), "test-stage")
        tables[name] = docs
    return tables


def texts(table) -> dict:
    return {r["doc_id"]: r["text"] for r in table.collect()}


def test_stages_are_the_dealt_ones(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(stages)[1:]
    columns = stages["documents"].columns
    assert all(t.columns == columns for t in list(stages.values())[:-1])


def test_language_keeps_prose(stages):
    before, after = texts(stages["documents"]), texts(stages["language ID"])
    assert set(after) <= set(before)
    assert all(not any(c.isalpha() for c in before[i]) for i in set(before) - set(after))


def test_one_of_each_group_of_near_copies_stays(stages):
    rows = list(texts(stages["language ID"]).items())
    wanted = {c for _, _, _, c in brute.jaccard_classes(rows)}
    assert set(texts(stages["n-gram Jaccard join"])) == wanted


def test_passages_stay_once(stages):
    before, after = texts(stages["n-gram Jaccard join"]), stages["substring dedup"].collect()
    wanted = {i: (n, gone, kept) for i, n, gone, kept in brute.without_windows(list(before.items()))}
    assert {r["doc_id"] for r in after} == {i for i, (n, gone, _) in wanted.items() if gone < n or n == 0}
    for r in after:
        _, gone, kept = wanted[r["doc_id"]]
        assert r["text"] == (kept if gone else before[r["doc_id"]]) and r["n_chars"] == len(r["text"])


def test_mixing_repeats_nothing(stages):
    before = texts(stages["substring dedup"])
    after = stages["mixing sources to target weights"].collect()
    assert len({r["doc_id"] for r in after}) == len(after) <= len(before)
    assert all(before[r["doc_id"]] == r["text"] for r in after)


def test_packing_holds_what_is_left(stages):
    left = texts(stages["mixing sources to target weights"])
    pieces = stages["packing"].collect()
    assert {p["doc_id"] for p in pieces} == set(left)
    lengths: dict = {}
    for p in pieces:
        lengths[p["doc_id"]] = lengths.get(p["doc_id"], 0) + p["length"]
    assert all(lengths[p["doc_id"]] == p["doc_tokens"] for p in pieces)


def test_odd_documents_pass_through(spark, odd_docs, no_docs, tmp_path):
    for kind, table in (("odd", odd_docs), ("none", no_docs)):
        folder = tmp_path / kind
        table.write.parquet(f"{folder}/documents.parquet")
        shutil.copyfile(f"{SF_DIR}/labels.parquet", folder / "labels.parquet")
        found = corpus_pipeline.run(spark, str(folder)).collect()
        assert bool(found) == (kind == "odd")


def test_queries_are_registered():
    named = registry.queries()
    assert set(queries.queries()) <= set(named) and "pipeline" in named
    assert sorted(int(q[2:].split("_")[0]) for q in queries.queries() if q.startswith("op")) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())
