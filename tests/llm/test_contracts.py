"""What the operators promise for odd schemas and odd texts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tests.conftest import SF_DIR

from tallymart.llm import gram_resampling, language, line_dedup, packing, quality_rules, quality_trees, spelling, suffixes, token_files
from tallymart.sources.staging import scratch_path


@pytest.fixture(scope="module")
def small(spark):
    """Ids and labels as 32-bit numbers."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("doc_id", F.col("doc_id").cast("int"))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").withColumn("quality", F.col("quality").cast("smallint"))
    return docs, labels


@pytest.mark.parametrize("apply", [
    lambda d, _: gram_resampling.resample(d, d), lambda d, _: line_dedup.drop_lines(d).select("row.doc_id"),
    lambda d, _: language.predict_language(d), lambda d, _: packing.pack(d).select("doc_id").distinct(),
    quality_rules.quality_rules, quality_trees.quality_scores, lambda d, _: suffixes.remove_repeats(d),
    lambda d, _: token_files.read_token_files(token_files.write_token_files(d, scratch_path(d.sparkSession, "ids"))),
], ids=["resample", "lines", "language", "pack", "rules", "trees", "bytes", "files"])
def test_ids_of_any_whole_type(small, apply):
    docs, labels = small
    got = sorted(r["doc_id"] for r in apply(docs, labels).select("doc_id").collect())
    assert got == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_spelling_takes_ids_of_any_whole_type(small):
    docs, _ = small
    wide = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    assert sorted(spelling.word_counts(docs).collect()) == sorted(spelling.word_counts(wide).collect())


def test_only_letters_have_a_language(spark, small):
    odd = spark.createDataFrame([(-1, "² ½ Ⅷ 12 _ !"), (-2, "é"), (-3, None)], "doc_id int, text string")
    docs = small[0].unionByName(odd, allowMissingColumns=True)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict_language(docs).filter("doc_id < 0").collect()}
    assert found[-1] == found[-3] == ("und", 0.0) and found[-2][0] != "und"
