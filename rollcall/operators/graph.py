"""Connected components of edges that stay in Spark."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share; a temporary one only where the session names
    none and its master is local (tests)."""
    folder, present = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    if not (folder or present) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = folder or present or tempfile.mkdtemp(prefix="rollcall-")
    if not present:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a loop's plan does not grow and a lost executor's rows are read again."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every end of an edge; a component is called by its smallest node.

    In turn every node's larger neighbours, then its smaller ones, are hung on the smallest node that it
    sees, until nothing moves: a number of rounds in the order of the logarithm of the nodes. Self-loops and repeated
    edges are allowed, null ends count as no edge, and an empty table gives an empty result.
    """
    usable = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null")
    nodes = usable.select("x").union(usable.select("y")).distinct()
    now = cut(usable.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())

    def hang(pairs: DataFrame, around: DataFrame) -> DataFrame:
        """Of each node ``x`` the neighbours ``y`` on its least: pairs (neighbour, least) that differ."""
        least = cut(around.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("least")))
        return pairs.join(least, "x").select(F.col("y").alias("x"), F.col("least").alias("y")).filter("x <> y")

    while not now.isEmpty():
        back = now.select(F.col("y").alias("x"), F.col("x").alias("y"))
        far = cut(hang(back, now.union(back)).distinct())  # larger neighbours
        roots = far.groupBy("x").agg(F.min("y").alias("y"))
        new = cut(hang(far, far).select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).union(roots).distinct())
        still = new.count() == now.count() and new.join(now, ["x", "y"], "left_anti").isEmpty()  # both are distinct
        now = new
        if still:
            break
    return nodes.join(now.groupBy("x").agg(F.min("y").alias("y")), "x", "left").select(F.col("x").alias("node"), F.coalesce("y", "x").alias("component"))
