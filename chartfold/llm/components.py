"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

EDGES_A_PARTITION = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.join(low, both.a == low.u).where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    rest = down.join(low, down.a == low.u).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the least node that the node reaches.  ``edges`` has comparable columns a, b.

    Nodes without an edge to another node do not appear.  No edge list
    reaches the driver; it reads one row of counts per round.
    """
    count = 0
    now = durable(edges.where("a != b and a is not null and b is not null")
                  .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        # few edges make few partitions, and so few files in every shuffle of the round
        if seen is not None:
            now = now.coalesce(count // EDGES_A_PARTITION + 1)
        now = durable(_small_star(_large_star(now)))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        count = state[0]
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
