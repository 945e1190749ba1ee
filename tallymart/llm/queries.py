"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import (
    embeddings, gram_resampling, language, line_dedup, mixing, ngram_join, oracles, packing, phrases,
    quality_rules, quality_trees, spelling, suffixes, token_files,
)
from tallymart.sources.staging import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_ngram_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op3_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(documents(spark, sf_dir), folder)
    return token_files.read_token_files(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(documents(spark, sf_dir))


def op5_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_repeats(documents(spark, sf_dir)).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_language(documents(spark, sf_dir))


def op7_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.label_domains(table(spark, sf_dir, "labels"))
    mixed = mixing.mix(documents(spark, sf_dir), labelled, carry=("doc_id",))
    shares = [F.col("_p")[i].alias(f"p_{d}") for i, d in enumerate(mixing.TARGETS)]
    return mixed.select("_document.doc_id", "n_tokens", *shares, "rate")


def op9_itq_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link(table(spark, sf_dir, "embeddings"))


def op10_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_gram_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gram_resampling.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op12_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(documents(spark, sf_dir)).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_trie_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    named = [
        op1_ngram_regression, op2_curve_packing, op3_bit_planes, op4_lsh_forest,
        op5_phrase_automata, op6_kernel_language, op7_boosted_quality, op8_soft_mixing,
        op9_itq_codes, op10_previous_factors, op11_gram_resampling, op12_line_bitmaps,
        op13_trie_frontier,
    ]
    return {query.__name__: query for query in named} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.oracles()
