"""Sinks. The output committer makes each of them appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.operators.documents import with_version
from rollcall.sources.readers import exists


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def sorted_fields(c: Column, kind: T.DataType) -> Column:
    """The value with the fields of all its structs in the order of their names."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[sorted_fields(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(c.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: sorted_fields(x, kind.elementType))
    return c


def json_document(df: DataFrame, pretty: bool = True) -> Column:
    """A row as JSON text with sorted names; null fields are written, lines are indented if ``pretty``."""
    parts = [sorted_fields(F.col(f.name), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return F.to_json(F.struct(*parts), {"pretty": str(pretty).lower(), "ignoreNullFields": "false"})


def snapshots(df: DataFrame, key: str) -> DataFrame:
    """The registry's rows as documents: the key and the row's JSON text."""
    return df.select(F.col(key), json_document(df).alias("value"))


def document_files(documents: DataFrame, folder: str, pretty: bool = False) -> None:
    """Documents as JSON text under a folder for each slug and version, so that a changed document
    gets a place of its own and an unchanged one is written where it was."""
    content = [c for c in documents.columns if c != "slug"]
    plain = F.to_json(F.struct("slug", *content))
    text = documents.withColumn("value", json_document(documents) if pretty else plain)
    versioned = with_version(text, "slug", "value")
    versioned.select("slug", "version", "value").write.mode("overwrite").partitionBy("slug", "version").text(folder)


def changed_document_files(documents: DataFrame, folder: str) -> DataFrame:
    """Writes documents (slug and content) under a folder for each slug and version of its content, those only that are not
    there yet, and gives the (slug, version) of all of them.

    What is there is read from the names of the folders, not from files. The committer of the write moves files in
    only when a task and then the job has ended well, so a failed task leaves nothing, and a rerun writes nothing.
    """
    spark = documents.sparkSession
    text = with_version(documents.withColumn("value", json_document(documents, pretty=False)), "slug", "value").select("slug", "version", "value")
    new = text
    if exists(spark, f"{folder}/slug=*"):
        there = spark.read.schema("value string, slug string, version string").text(folder).select("slug", "version").distinct()
        new = text.join(there, ["slug", "version"], "left_anti")
    new.write.mode("append").partitionBy("slug", "version").text(folder)
    return text.select("slug", "version")


def point_table(df: DataFrame, path: str, key: str, parts: int) -> None:
    """A table in which one value of ``key`` lies in one folder of ``parts``, in order, in row groups that tell by a
    bloom filter whether they have it; see point_rows."""
    placed = df.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    placed = placed.repartition(parts, "_part").sortWithinPartitions("_part", key)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.page.row.count.limit": "2000"}
    placed.write.options(**options).partitionBy("_part").parquet(path)


def point_rows(spark: SparkSession, path: str, key: str, value: object, parts: int) -> DataFrame:
    """The rows of one value of a point_table's key: files of one folder are opened, pages by their bounds."""
    rows = spark.read.parquet(path)
    kind = rows.schema[key].dataType
    part = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast(kind)), F.lit(parts)).cast("int")).first()[0]
    return rows.filter((F.col("_part") == part) & (F.col(key) == F.lit(value).cast(kind))).drop("_part")


def matrix(df: DataFrame, *columns: str, limit: int = 256) -> str:
    """A compact JSON array for a fan-out of at most ``limit`` rows; more are an error, not cut off."""
    row = df.limit(limit + 1).agg(F.count("*").alias("n"), F.to_json(F.sort_array(F.collect_list(F.struct(*columns)))).alias("m")).first()
    if row["n"] > limit:
        raise ValueError(f"more than {limit} rows for a matrix")
    return row["m"]


def csv_lines(df: DataFrame) -> DataFrame:
    """Rows as CSV text with quotes where they are needed."""
    return df.select(F.to_csv(F.struct(*df.columns)).alias("line"))
