"""Connected components of an edge table, by repeated contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.session import scratch_dir


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of `edges(a, b)`, as (node, component).

    Each round every node points to its smallest neighbour, edges are redrawn between the
    nodes pointed to, and labels follow.  Only local minima survive a round, so rounds grow
    with the logarithm of the node count.  Minima are pre-aggregated in the tasks; a node with
    very many edges makes a skewed join, which adaptive execution splits.  No edge is an
    empty result; self loops and repeated edges do no harm.
    """
    edges = store(edges.where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = store(least.select(F.col("a").alias("u"), F.least("a", "m").alias("p")), "parents")
        if labels is None:
            labels = store(least.toDF("node", "component"), "labels")
        else:
            moved = labels.join(least, F.col("component") == F.col("u"), "left")
            labels = store(moved.select("node", F.coalesce("p", "component").alias("component")), "labels")
        left = edges.join(least.toDF("a", "pa"), "a").join(least.toDF("b", "pb"), "b").where("pa <> pb")
        edges = store(left.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
