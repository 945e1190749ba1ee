"""Connected components of a graph given as a table of edges.

Every node moves to the neighbour of least hash, or stays if its own is less; edges move along, and
loops and repeated edges go. Hashed order makes any graph, also a long chain of ascending ids,
shrink by a fixed share in each round. All tables stay distributed; a hub's neighbours are reduced
to one minimum before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.sources.staging import stage


def _ranked(column: str) -> Column:
    return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("id"))


def components(edges: DataFrame) -> DataFrame:
    """id and component (one of its ids) of every id in the edges a, b."""
    pairs = edges.select("a", "b").filter("a <> b")
    pairs = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = stage(pairs, "edges")
    names = pairs.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id"))
    while not pairs.isEmpty():
        least = pairs.groupBy("a").agg(F.min(_ranked("b")).alias("m"))
        moves = stage(
            least.select(F.col("a").alias("old"), F.least(_ranked("a"), "m")["id"].alias("new")), "moves"
        )
        names = stage(
            names.join(moves, F.col("component") == F.col("old"), "left")
            .select("id", F.coalesce("new", "component").alias("component")),
            "components",
        )
        to_a = moves.select(F.col("old").alias("a"), F.col("new").alias("na"))
        to_b = moves.select(F.col("old").alias("b"), F.col("new").alias("nb"))
        pairs = stage(
            pairs.join(to_a, "a").join(to_b, "b").filter("na <> nb")
            .select(F.col("na").alias("a"), F.col("nb").alias("b")).distinct(),
            "edges",
        )
    return names
