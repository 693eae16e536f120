"""Components of pairs, for identity merges, and the checkpoints that cut an iteration's lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class NotConverged(RuntimeError):
    """An iteration reached its bound on rounds before it settled; its state is no result."""


def shared_root(spark: SparkSession, prefix: str) -> str:
    """The folder of ``spark.checkpoint.dir``. Without that setting a temporary one, which only a local master's tasks all see."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=prefix)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession, "spark-checkpoint-"))
    return df.checkpoint()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)`` with the least node of each.

    Alternates the large-star and small-star steps, which contract a path of n nodes in about log n rounds. Every round is two partial
    aggregations and two joins on narrow rows, and its result is checkpointed. Edges are settled once they are stars around the least node
    of each, so no round is spent on finding that nothing moves, and none on edges that are stars from the start. Self loops and nulls are
    ignored; an empty input gives an empty result. Raises ``NotConverged`` rather than give roots that are not settled.
    """
    pairs = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for done in range(max_rounds + 1):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # In a star the centre is less than all its neighbours, and any other node has one neighbour only.
        if both.groupBy("u").agg(F.min("v").alias("v"), F.count("*").alias("n")).where("v < u AND n > 1").isEmpty():
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        if done == max_rounds:
            break
        # Large star: the larger neighbours of each node move to its least neighbour.
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the smaller neighbours of each node move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        pairs = cut_lineage(small)
    raise NotConverged(f"components are not settled after {max_rounds} rounds")


def least_member(pairs: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """``(node, root)``: the least node that each node of a pair reaches; pairs of a node with itself, and nulls, give no row."""
    return components(pairs.select(F.col(a).alias("a"), F.col(b).alias("b")), max_rounds).withColumnRenamed("component", "root")
