"""Connected components of a link table, without any driver-side or single-task state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import materialize, shuffles_removed


def _star(edges: DataFrame, up: bool) -> DataFrame:
    """One star step: neighbours point to the least neighbour. Every edge points to its smaller node, u > v.

    ``up`` moves the larger neighbours of a node, else the smaller ones and the
    node itself. Minima are pre-aggregated before the shuffle, and the join
    that hands them out may be split at a hot node.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if up else edges
    least = near.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
    moved = near.join(least, "u")
    if up:
        return moved.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    # The least neighbour stays where it is; its row moves the node itself.
    return moved.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("low").alias("v"))


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one other node, and none points to a node that points on."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    with shuffles_removed(edges.sparkSession):
        return (ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
                .filter("out > 1 OR (out > 0 AND into > 0)").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node in ``links`` (u, v).

    Alternating star steps until all nodes point to the least one; a chain of n
    nodes takes about log(n) rounds. Each round is written to the shared folder.
    """
    # A round reads its edges several times, so the links are written before the first.
    edges = materialize(links.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        edges = materialize(_star(_star(edges, up=True), up=False).distinct())
        if _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
