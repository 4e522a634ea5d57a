"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_dir

#: Each round at least halves the depth of the trees in practice; graphs need about log2 of their width.
MOST_ROUNDS = 60


def _stored(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _outward(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are tied to its least neighbour, or to itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).withColumn("least", F.least("a", "least"))
    tied = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return tied.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()


def _inward(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are tied to the least of them."""
    least = _least(links)
    tied = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b"))).filter("a != b").distinct()


def _settled(stars: DataFrame) -> bool:
    """Whether every node is tied to one other, which is tied to none."""
    ties = stars.select(F.col("a").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("top")).unionByName(
        stars.select(F.col("b").alias("node"), F.lit(0).alias("tied"), F.lit(1).alias("top")))
    nodes = ties.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("top").alias("top"))
    return nodes.filter("tied > 1 OR tied > 0 AND top > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``least`` of each node that has a link (a, b): the least node of its component.

    Links go either way and may repeat; nodes are of any type with an order; links with a null and of
    a node to itself are left out. Stars are made by turns outward and inward until nothing moves;
    each round is written to the shared folder. A node with many neighbours is only aggregated and
    joined, never gathered.
    """
    spark: SparkSession = links.sparkSession
    folder = work_dir(spark, "components")
    ordered = links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = _stored(ordered.distinct(), f"{folder}/0")
    for turn in range(1, MOST_ROUNDS):
        stars = _stored(_inward(_outward(stars)), f"{folder}/{turn}")
        if _settled(stars):
            break
    else:
        raise RuntimeError("components did not settle")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("least")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct())
