from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.conftest import SF_DIR
from tests.llm import brute

from tallymart.llm import gram_resampling, line_dedup, spelling


def order(row: tuple) -> tuple:
    return (row[0] is None, row[0] or 0, *map(str, row[1:]))


@pytest.fixture(scope="module")
def given_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.collect()]


# --- resampling -----------------------------------------------------------------------------


def drawn(docs, target) -> list[tuple]:
    rows = gram_resampling.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted(map(tuple, rows.collect()), key=order)


def test_gains_scores_and_ranks(spark, given_texts, odd_docs, odd_texts):
    target = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    wanted = [r["text"] for r in target.collect()]
    for docs, texts in (given_texts, (odd_docs, odd_texts)):
        assert drawn(docs, target) == sorted(brute.resampled(texts, wanted), key=order)


def test_equal_scores_are_drawn_in_order_of_ids(spark):
    text = " ".join(f"word{i}" for i in range(30))
    texts = [(5, text)] * 40 + [(None, text)] * 30 + [(9, text), (3, "too few words")]
    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(5)
    target = spark.createDataFrame([(1, None), (2, "word1 word2"), (3, "")], "item_id int, text string")
    got = drawn(docs, target)
    assert got == sorted(brute.resampled(texts, [None, "word1 word2", ""]), key=order)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 71 * 25 // 100 + 1))


def test_resampling_nothing_or_towards_nothing(no_docs, odd_docs, odd_texts):
    assert drawn(no_docs, no_docs) == []
    assert drawn(odd_docs, no_docs) == sorted(brute.resampled(odd_texts, []), key=order)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.none() | st.text(alphabet="aZ\x00 é×1-\n\x7f日", max_size=20), max_size=6))
def test_features_are_those_of_the_pattern(some):
    found = gram_resampling.Features(pa.array(some, pa.string()))
    plain = [brute.gram_buckets(t) for t in some]
    assert found.n_words().tolist() == [n for n, _ in plain]
    assert found.n_features().tolist() == [len(b) for _, b in plain]
    gain = np.arange(10_000) - 5000
    assert found.sums(gain).tolist() == [sum(b - 5000 for b in buckets) for _, buckets in plain]
    flat = np.array([b for _, buckets in plain for b in buckets], np.int64)
    assert found.counts().tolist() == np.bincount(flat, minlength=10_000).tolist()


# --- lines ----------------------------------------------------------------------------------


def kept(docs) -> list[tuple]:
    rows = line_dedup.drop_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, rows), key=order)


@pytest.fixture(scope="module")
def lined_texts(spark):
    """One line in nearly all documents, lines that differ in case and edges, repeated and null ids."""
    choose = random.Random(11)
    texts = []
    for _ in range(300):
        lines = ["The line that all have, Ünïted"] * choose.randrange(3)
        lines += [f"line number {choose.randrange(60)} of some" + " " * choose.randrange(2) for _ in range(4)]
        lines += [choose.choice(["short", "", "  ", "TEN CHARSX", "ten charsx\t", "nine char", "ünïcode te"])]
        choose.shuffle(lines)
        texts.append((choose.choice([None, *range(120)]), "\n".join(lines)))
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(7), texts


@pytest.mark.parametrize("partitions", [1, 40])
def test_lines_of_earlier_documents_go(spark, given_texts, lined_texts, odd_docs, odd_texts, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set(adaptive, "false")
    try:
        for docs, texts in (given_texts, lined_texts, (odd_docs, odd_texts)):
            assert kept(docs) == sorted(brute.without_lines(texts), key=order)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset(adaptive)


def test_bitmaps_tell_what_texts_keep(lined_texts, no_docs):
    docs, texts = lined_texts
    rows = line_dedup.line_bitmaps(docs).collect()
    plain = brute.without_lines(texts)
    assert sorted((tuple(r)[:3] for r in rows), key=order) == sorted((r[:3] for r in plain), key=order)
    for row in rows:
        if row["keep_bits"] is None:
            assert row["n_dropped"] == 0
        else:
            flags = np.unpackbits(np.frombuffer(zlib.decompress(bytes(row["keep_bits"])), np.uint8))
            assert (flags == 0).sum() == row["n_dropped"] and len(flags) < row["n_lines"] + 8
    assert line_dedup.line_bitmaps(no_docs).count() == 0 and kept(no_docs) == []


def test_texts_keep_all_that_is_no_line_to_drop(spark):
    texts = [(1, "a\r\n\r\nsame line here\r\n"), (2, "Same Line Here \n\n\nb\n"), (3, None), (3, "\n"), (4, "same line here")]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    assert kept(docs) == sorted(brute.without_lines(texts), key=order)
    assert line_dedup.drop_lines(docs, ("doc_id", "text")).filter("row.doc_id = 2").first()["kept"] == "\n\nb\n"


# --- spelling -------------------------------------------------------------------------------


def found_variants(docs, **how) -> list[tuple]:
    rows = spelling.variants(docs, **how).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(map(tuple, rows.collect()))


def test_variants_of_the_given_words(given_texts, odd_docs, odd_texts):
    for docs, texts in (given_texts, (odd_docs, odd_texts)):
        assert found_variants(docs) == brute.spelling_variants(brute.spelling_words(texts))


def test_variants_of_close_words(spark):
    """Few letters, many lengths: all kinds of edits at all places, chains of forms, a very long word."""
    choose = random.Random(4)
    texts = []
    for i in range(60):
        own = ["".join(choose.choice("abÿ") for _ in range(choose.randrange(5, 9))) for _ in range(30)]
        own += ["straße", "Straße"] * 9 + ["strasse"] * 2 + ["q" * 3000, "q" * 3001, "q" * 2999 + "Z"]
        texts.append((choose.choice([None, i]), " ".join(own)))
    texts.append((None, "planet " * 100 + "planett " * 40 + "planettt " * 12 + "planetttt " * 5))
    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(4)
    words = brute.spelling_words(texts, one_in=7)
    plain = brute.spelling_variants(words, ratio=2)
    assert found_variants(docs, form_times=2, one_in=7) == plain
    assert len({len(r[0]) for r in plain}) > 3 and any(r[1] != r[2] and r[1] for r in plain)


@settings(deadline=None, max_examples=15)
@given(st.sets(st.text(alphabet="ab", min_size=1, max_size=7), max_size=30))
def test_pairs_are_all_that_are_one_edit_apart(spark, words):
    rows = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    assert sorted(map(tuple, rows)) == sorted((a, b) for a in words for b in words if a < b and brute.one_edit(a, b))


def test_no_texts_no_words(no_docs, spark):
    assert found_variants(no_docs) == []
    assert spelling.word_counts(spark.createDataFrame([(1, "abcde fghij")] * 9, "doc_id long, text string")).count() == 0


def test_counted_words(given_texts):
    docs, texts = given_texts
    rows = {r["word"]: r["n"] for r in spelling.word_counts(docs.withColumn("n", F.lit(1))).collect()}
    assert rows == brute.spelling_words(texts)
