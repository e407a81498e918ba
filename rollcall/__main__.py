"""Command line over a registry table (Parquet): python -m rollcall COMMAND --registry PATH ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.text import fixed_width
from rollcall.operators import registry
from rollcall.sources import readers, writers

TODO = list(registry.DONE)
READY = ["transcribe_status", "name_speakers_status", "chapterize_status"]


def _day():
    return F.coalesce(*[F.substring(c, 1, 10) for c in ("event_date", "viebit_pub_date", "discovered_at")])


def pending_matrix(df: DataFrame, floor: str, limit: int) -> str:
    rows = df.filter("viebit_filename is not null and event_date is not null")
    rows = registry.pending(rows, floor, TODO, _day()).orderBy(_day(), "meeting_key").limit(limit)
    return writers.matrix(rows, "meeting_key", limit=limit)


def status(df: DataFrame, limit: int) -> DataFrame:
    newest = [F.coalesce("event_date", "viebit_pub_date", "discovered_at").desc(), F.coalesce("event_time", F.lit("")).desc(), F.col("meeting_key")]
    return df.orderBy(*newest).limit(limit).select("meeting_key", fixed_width(F.col("body_name"), 32).alias("body"), *registry.STATUS)


def ci_health(df: DataFrame, floor: str) -> DataFrame:
    told = F.coalesce(F.trim("last_error") != "", F.lit(False)) & (_day() >= floor)
    stuck = (F.col("process_attempts") >= registry.MAX_ATTEMPTS) & ~registry.done("chapterize_status")
    return df.agg(F.max("event_date").alias("newest_event"), F.count_if(told).alias("errors"), F.count_if(stuck).alias("parked"))


def verify(df: DataFrame, results: DataFrame) -> DataFrame:
    return registry.missing_results(df, results, "meeting_key", ("complete", "pending", "failed"))


def merge_results(df: DataFrame, results: DataFrame) -> DataFrame:
    return registry.merge_results(df, results, "meeting_key", TODO, "process_attempts", "cost_usd")


def reset_meeting(df: DataFrame, key: str) -> DataFrame:
    return registry.reset(df, F.col("meeting_key") == key, TODO, "process_attempts", "last_error")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="rollcall")
    p.add_argument("command", choices=["pending-matrix", "status", "ci-health", "merge-results", "verify-run-results", "reset-meeting", "publishable"])
    p.add_argument("--registry", required=True)
    p.add_argument("--results")
    p.add_argument("--out", help="where the new registry is written; never the folder that is read")
    p.add_argument("--key")
    p.add_argument("--floor", default="2025-04-01")
    p.add_argument("--limit", type=int, default=200)
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    df = registry.evolve(spark.read.parquet(a.registry))
    results = readers.results(spark, a.results, df.select(*[c for c in df.columns]).schema.simpleString()[7:-1]) if a.results else None
    if a.command == "pending-matrix":
        print(pending_matrix(df, a.floor, a.limit))
    elif a.command in ("merge-results", "reset-meeting"):
        out = merge_results(df, results) if a.command == "merge-results" else reset_meeting(df, a.key)
        out.write.parquet(a.out)
    else:
        shown = {"status": lambda: status(df, a.limit), "ci-health": lambda: ci_health(df, a.floor), "verify-run-results": lambda: verify(df, results), "publishable": lambda: registry.publishable(df, READY, "event_date", "body_name").select("meeting_key")}
        shown[a.command]().show(a.limit, truncate=False)


if __name__ == "__main__":
    main()
