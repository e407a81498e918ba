"""Incremental discovery and merging with Structured Streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources.readers import exists

BOOTSTRAP = "2025-04-01T00:00:00"


def next_cursor(events: DataFrame, modified: str, cursor: str | None, incremental: bool = True) -> str:
    """High-water mark after a batch: the greatest time stamp as text; a backfill leaves it alone."""
    now = cursor or BOOTSTRAP
    if not incremental:
        return now
    top = events.filter(F.col(modified).isNotNull()).agg(F.max(modified)).first()[0]
    return max(now, top) if top else now


def split_malformed(events: DataFrame, *required: str) -> tuple[DataFrame, DataFrame]:
    """(usable, malformed) rows."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    return events.filter(ok), events.filter(~ok)


def from_sources(sources: dict[str, Callable[[], DataFrame]], warn: Callable[[str], None]) -> list[DataFrame]:
    """The tables of the sources that can be read; a failing one warns and leaves the others."""
    out = []
    for name, read in sources.items():
        try:
            df = read()
            df.take(1)
            out.append(df)
        except Exception as error:  # noqa: BLE001
            warn(f"{name}: {error}")
    return out


def merge_stream(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame], key: str = "meeting_key", parts: int = 64, max_files: int = 1000) -> None:
    """Merges files that arrived since the last run into a table, once each.

    The table lies in ``parts`` parts by a hash of ``key``, which never changes for a table. A batch writes the
    next version of the parts that its keys touch and leaves the others; of a part the last two versions
    are kept, so a batch that is repeated reads what it read before and writes the same version again.
    ``merge(present, batch)`` must give rows of the keys of both, and be idempotent. A new checkpoint goes on
    behind the versions that are there.
    """
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    base = _first_version(spark, target, checkpoint)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)

    def apply(batch: DataFrame, number: int) -> None:
        touched = {r["part"] for r in batch.select(part.alias("part")).distinct().collect()}  # at most ``parts``
        if not touched:
            return
        own = [(v, k, path) for v, k, path in _versions(spark, target) if k in touched and v < base + number]
        last = {k: (v, path) for v, k, path in sorted(own)}
        present = spark.read.parquet(*[path for _, path in last.values()]) if last else None
        merged = merge(present, batch).withColumn("part", part)
        merged.write.mode("overwrite").partitionBy("part").parquet(f"{target}/version={base + number}")
        for v, k, path in own:
            if v < last[k][0]:
                _delete(spark, path)

    rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def _versions(spark: SparkSession, target: str) -> list[tuple[int, int, str]]:
    """(version, part, path) of every part that is there."""
    at, fs = _fs(spark, f"{target}/version=*/part=*")
    out = []
    for status in fs.globStatus(at) or []:
        path = status.getPath()
        out.append((int(path.getParent().getName().split("=")[1]), int(path.getName().split("=")[1]), path.toString()))
    return out


def _first_version(spark: SparkSession, target: str, checkpoint: str) -> int:
    """Version of a checkpoint's first batch: written down when the checkpoint is new."""
    note = f"{target}/_streams/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    if exists(spark, checkpoint) and exists(spark, note):
        return int(spark.read.text(note).first()[0])
    first = 1 + max((v for v, _, _ in _versions(spark, target)), default=-1)
    spark.createDataFrame([(str(first),)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return first


def latest_version(spark: SparkSession, target: str) -> DataFrame | None:
    """The table: the last version of each of its parts; null before the first batch."""
    last = {k: path for _, k, path in sorted(_versions(spark, target))}
    return spark.read.parquet(*last.values()) if last else None


def remaining(inputs: DataFrame, finished: DataFrame, key: str, version: str) -> DataFrame:
    """Inputs without a finished output of the same content version."""
    return inputs.join(finished.select(key, version).distinct(), [key, version], "left_anti")


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Tumbling counts; on a stream, rows later than ``late`` are dropped and windows are final then."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))
