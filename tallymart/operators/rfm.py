"""Recency, frequency and monetary scores, and customer segments built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.calendar import elapsed_days
from tallymart.functions.numeric import ratio, summed
from tallymart.operators.clusters import weighted_kmeans
from tallymart.operators.filters import completed
from tallymart.operators.ranks import weighted_quantiles
from tallymart.params import (
    SEGMENT_CHURN_RISK,
    SEGMENT_HIGH_FREQUENCY,
    SEGMENT_HIGH_VALUE,
    SEGMENT_LOW_ACTIVITY,
    SEGMENT_POTENTIAL,
    Params,
)
from tallymart.sources.staging import stage

METRICS = ("recency", "frequency", "monetary")
SCORES = tuple(f"{m}_score" for m in METRICS)


def _customer_types(df: DataFrame, params: Params) -> DataFrame:
    """Stored totals per (customer, type), the one heavy pass over the orders.

    Grouping by the type as well keeps all aggregates fixed-width, hence hash-aggregated.
    """
    typed = (
        completed(df, params)
        .dropna(subset=["customer_id"])
        .groupBy("customer_id", "customer_type")
        .agg(
            F.count("order_id").alias("n"),
            summed().alias("spent"),
            F.min("order_date").alias("first"),
            F.max("order_date").alias("last"),
        )
    )
    return stage(typed, "customer-types")


def _rfm(typed: DataFrame) -> DataFrame:
    earliest = F.when(F.col("customer_type").isNotNull(), F.struct("first", "customer_type"))
    customers = typed.groupBy("customer_id").agg(
        F.max("last").alias("last"),
        F.sum("n").alias("frequency"),
        F.sum("spent").alias("spent"),
        F.min(earliest)["customer_type"].alias("customer_type"),
    )
    snapshot = typed.agg(F.max("last").alias("snapshot"))
    return customers.crossJoin(F.broadcast(snapshot)).select(
        "customer_id",
        elapsed_days(F.col("last"), F.col("snapshot")).alias("recency"),
        "frequency",
        F.col("spent").cast("double").alias("monetary"),
        "customer_type",
    )


def rfm(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Days since the last order, number of orders, amount spent and first customer type.

    The first type is that of the earliest order.
    """
    return _rfm(_customer_types(df, params))


def _bin(value: Column, edges: Column) -> Column:
    """1-based bin between distinct quantile edges; null when all edges coincide.

    The first bin includes its lower edge, and bins that tied edges would leave empty are
    dropped, so fewer than the asked-for number of bins may be used.
    """
    below = F.size(F.filter(edges, lambda edge: edge < value))
    return F.when(F.size(edges) > 1, F.greatest(F.lit(1), below)).cast("long")


def _edges(customers: DataFrame, levels: list[float]) -> DataFrame:
    """One row with the distinct quantile edges of each metric of a stored table."""
    pairs = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS
    ]
    counts = (
        customers.select(F.inline(F.array(*pairs)))
        .dropna(subset=["value"])
        .groupBy("metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = F.array_distinct("quantiles")
    return weighted_quantiles(stage(counts, "metric-counts"), ["metric"], levels).agg(
        *[F.max(F.when(F.col("metric") == m, edges)).alias(f"_edges_{m}") for m in METRICS]
    )


def rfm_scores(df: DataFrame, params: Params = Params()) -> DataFrame:
    """RFM with quantile scores from 1 to 5; a recent customer gets the high recency score."""
    customers = stage(_rfm(_customer_types(df, params)), "rfm")
    bins = params.score_bins
    levels = [i / bins for i in range(bins + 1)]
    scored = customers.crossJoin(F.broadcast(_edges(customers, levels))).withColumns(
        {f"{m}_score": _bin(F.col(m).cast("double"), F.col(f"_edges_{m}")) for m in METRICS}
    )
    recency = (F.lit(bins + 1) - F.col("recency_score")).cast("long")
    return scored.withColumn("recency_score", recency).drop(*[f"_edges_{m}" for m in METRICS])


def score_clusters(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """Cluster number of each combination of scores.

    There are at most bins ** 3 combinations (125) however many customers there are, so clustering
    them does not touch the orders again. A score that is null because all customers tie counts as 1.
    """
    filled = [F.coalesce(F.col(s), F.lit(1)).cast("long").alias(s) for s in SCORES]
    points = scored.select(*filled).groupBy(*SCORES).agg(F.count(F.lit(1)).alias("weight"))
    return weighted_kmeans(
        points, SCORES, params.n_clusters, params.cluster_restarts, params.cluster_iterations
    )


def _spending() -> Column:
    """Exact sum of what customers spent, wide enough for one who made a third of all orders."""
    return F.sum(F.col("monetary").cast("decimal(28,2)"))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Mean recency, frequency and spending of each cluster."""
    n = F.count(F.lit(1))
    return clustered.groupBy("cluster").agg(
        ratio(F.sum("recency"), n).alias("avg_recency"),
        ratio(F.sum("frequency"), n).alias("avg_frequency"),
        ratio(_spending(), n).alias("avg_monetary"),
        n.alias("count"),
    )


def name_segments(profile: DataFrame) -> DataFrame:
    """Name each profile row by comparing it with the quantiles of all profile rows.

    Several rows may get the same name. The profile has one row per cluster, so its quantiles
    are taken directly.
    """
    high = {
        m: F.percentile(f"avg_{m}", F.lit(0.7)).alias(f"_high_{m}") for m in METRICS
    }
    low = F.percentile("avg_frequency", F.lit(0.3)).alias("_low_frequency")
    limits = profile.agg(*high.values(), low)
    name = (
        F.when(F.col("avg_monetary") > F.col("_high_monetary"), SEGMENT_HIGH_VALUE)
        .when(F.col("avg_frequency") > F.col("_high_frequency"), SEGMENT_HIGH_FREQUENCY)
        .when(F.col("avg_recency") > F.col("_high_recency"), SEGMENT_CHURN_RISK)
        .when(F.col("avg_frequency") < F.col("_low_frequency"), SEGMENT_LOW_ACTIVITY)
        .otherwise(SEGMENT_POTENTIAL)
    )
    return (
        profile.crossJoin(F.broadcast(limits))
        .withColumn("segment", name)
        .drop(*[f"_high_{m}" for m in METRICS], "_low_frequency")
    )


def cluster_customers(df: DataFrame, params: Params = Params()) -> DataFrame:
    """RFM scores of every customer with the cluster they fall into."""
    scored = stage(rfm_scores(df, params), "rfm-scores")
    clusters = stage(score_clusters(scored, params), "score-clusters")
    same = [F.coalesce(scored[s], F.lit(1)) == clusters[s] for s in SCORES]
    return scored.join(F.broadcast(clusters), same).select(scored["*"], clusters["cluster"])


def customer_segments(clustered: DataFrame) -> DataFrame:
    """Clustered customers with the name of their segment."""
    named = name_segments(cluster_profile(clustered)).select("cluster", "segment")
    # One row per cluster.
    return clustered.join(F.broadcast(named), "cluster")


def segment_summary(segments: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        segments.groupBy("segment")
        .agg(
            n.alias("customer_count"),
            ratio(F.sum("recency"), n).alias("avg_recency_days"),
            ratio(F.sum("frequency"), n).alias("avg_orders"),
            ratio(_spending(), n).alias("avg_lifetime_value"),
        )
        .orderBy(F.desc("avg_lifetime_value"), "segment")
    )


def segment_sizes(segments: DataFrame) -> DataFrame:
    return segment_summary(segments).select(
        "segment",
        F.col("customer_count").alias("count"),
        F.col("avg_lifetime_value").alias("avg_monetary"),
    )
