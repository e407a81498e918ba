"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only where the session names none and runs on one machine (tests) is a temporary folder made; on a
    cluster that is an error, as executors could not see each other's files.
    """
    folder, present = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    if folder and not present:
        spark.sparkContext.setCheckpointDir(folder)
    folder = folder or present
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rollcall-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: for small tables inside iterations. Spark removes it once unused if
    spark.cleaner.referenceTracking.cleanCheckpoints is set, else it goes with the folder."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_stashes: list[str] = []


def stash(df: DataFrame) -> DataFrame:
    """Write a table that several later steps read to the shared folder, and read it back.

    Unlike a checkpoint it is columnar and compressed, so readers prune columns. Such tables stay
    below ``<checkpoint dir>/rollcall-stash`` until ``stashes_removed`` or the purge of the folder.
    """
    path = f"{scratch_dir(df.sparkSession)}/rollcall-stash/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stashes.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def stashes_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables stashed within, once what was made of them has been written."""
    before = len(_stashes)
    try:
        yield
    finally:
        for path in _stashes[before:]:
            delete_folder(spark, path)
        del _stashes[before:]


def drop_stash(*tables: DataFrame) -> None:
    """Delete stashed tables that no later step reads."""
    for df in tables:
        for name in df.inputFiles()[:1]:
            delete_folder(df.sparkSession, name.rsplit("/", 1)[0])


def connected_components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(id, component) for every id in ``edges``; component is the smallest id reachable.

    Alternating large-star and small-star rounds: O(log n) of them, each two grouped minima and two
    joins, until all that is left are stars. Edges stay in Spark; the driver only sees a flag. The grouped minimum is
    checkpointed before it is joined back, so adaptive execution can split the edges of a hub.
    Self-loops and repeated edges are allowed; an empty table gives an empty result.
    """
    cur = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cur.select(F.col("v").alias("k"), F.col("u").alias("w")).join(low.withColumnRenamed("u", "k"), "k")
        # a neighbour above the hub moves to the hub's minimum; every edge has exactly one such end
        large = cut(large.select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        moved = large.join(low, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        cur = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # stars: every edge leads from a node with no other edge to a node that leads nowhere
        ends = cur.select(F.col("u").alias("id"), F.lit(1).alias("out")).unionByName(cur.select(F.col("v").alias("id"), F.lit(0).alias("out")).distinct())
        tangled = ends.groupBy("id").agg(F.sum("out").alias("out"), F.min("out").alias("least")).filter("out > 1 or (out = 1 and least = 0)")
        if tangled.isEmpty():
            break
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
