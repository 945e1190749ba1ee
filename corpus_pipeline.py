"""Documents to packed sequences: language, near copies, shared passages, mixture, packing.

Every stage gets what its predecessor kept, with the columns of documents, and its decisions take
effect: documents that it rejects, or the words that it removes, are not in its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import language, mixing, ngram_join, packing, phrases
from tallymart.sources.staging import stage

#: Prose in a known language scores far above it; with four languages a guess scores 0.25.
LEAST_LANGUAGE_SCORE = 0.3
LENGTH = 1024


#: Rows of an Arrow batch. Whole rows with their texts pass, and a worker holds a batch both ways.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Limit the batches of this session, unless they are smaller already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without letters and those whose language nothing tells."""
    small_batches(spark)
    return language.keep_languages(docs, LEAST_LANGUAGE_SCORE)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near copies."""
    small_batches(spark)
    return ngram_join.keep_one(docs)


def without_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that an earlier document has; a text that has nothing else goes.

    A text that loses words is rewritten with single spaces, and its n_chars counted again.
    """
    small_batches(spark)
    others = [c for c in docs.columns if c != "text"]
    found = phrases.remove_repeats(docs, others, rewrite=False)
    found = found.filter((F.col("n_removed") < F.col("n_words")) | (F.col("n_words") == 0))
    changed = F.col("n_removed") > 0
    columns = {c: F.col(f"row.`{c}`") for c in others} | {"text": F.col("kept")}
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(columns["n_chars"])
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Thin out poor and toxic documents to their share beside the good ones; none is repeated."""
    small_batches(spark)
    labelled = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixing.repeat_by_rate(mixing.mix(docs, labelled, hold="good", most=1.0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids, near documents together."""
    small_batches(spark)
    return packing.pack(docs, LENGTH)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", without_near_copies),
    ("substring dedup", without_shared_passages),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: Classifiers, signatures and token ids are beyond SQL. The tests hold the Jaccard and substring stages
#: to brute force; language, mixing and packing are checked in part only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
