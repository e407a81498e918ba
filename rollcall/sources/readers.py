"""Sources. All of them read with Spark's own readers, so paths may be in any store that Spark knows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from rollcall.functions.text import base64_url, clean_text, file_stem, links, unescape_html
from rollcall.functions.timeparse import clock_to_seconds, mail_date
from rollcall.operators.documents import DOCUMENT

UTTERANCE = "meeting_key string, idx long, t0 double, t double, start double, start_sec double, t1 double, end double, end_sec double, text string, speaker string, label string, confidence double"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a missing file is an empty table, blank lines are skipped."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def utterances(spark: SparkSession, path: str) -> DataFrame:
    """Utterances whose start and end go by any of their names."""
    rows = json_lines(spark, path, UTTERANCE)
    return rows.select("meeting_key", "idx", F.coalesce("t0", "t", "start", "start_sec").alias("t0"), F.coalesce("t1", "end", "end_sec").alias("t1"), "text", "speaker", "label", "confidence")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Published documents, one JSON file each."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).json(path)


def results(spark: SparkSession, folder: str, row_schema: str) -> DataFrame:
    """Result records anywhere below a folder; other JSON files are passed over. ``ord`` follows paths."""
    raw = spark.read.schema(f"meeting_key string, status string, row struct<{row_schema}>").option("multiLine", True).option("recursiveFileLookup", True).json(folder)
    raw = raw.withColumn("path", F.col("_metadata.file_path")).filter("row.meeting_key is not null")
    return raw.select("status", "path", "row.*").withColumn("ord", F.col("path"))


def rss(spark: SparkSession, path: str) -> DataFrame:
    """title (without .mp4), guid, published of every item that has a title and a guid."""
    rows = spark.read.format("xml").option("rowTag", "item").schema("title string, guid string, pubDate string").load(path)
    return rows.filter("trim(title) <> '' and trim(guid) <> ''").select(file_stem(F.trim("title")).alias("title"), F.trim("guid").alias("guid"), mail_date(F.col("pubDate")).alias("published"))


def captions(spark: SparkSession, path: str) -> DataFrame:
    """path, idx, start, end, lines of each cue of WebVTT files; other lines are passed over."""
    cue = r"^(\S+) --> (\S+)"
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    by = W.partitionBy("path").orderBy("line")
    rows = rows.withColumn("idx", F.sum(F.col("text").rlike(cue).cast("int")).over(by)).filter("idx > 0")
    at = lambda i: F.max(F.when(F.col("text").rlike(cue), clock_to_seconds(F.regexp_extract("text", cue, i))))
    said = F.sort_array(F.collect_list(F.when(~F.col("text").rlike(cue) & (F.trim("text") != "") & ~F.trim("text").rlike(r"^\d+$"), F.struct("line", "text"))))
    cues = rows.groupBy("path", "idx").agg(at(1).alias("start"), at(2).alias("end"), said.alias("said"))
    return cues.select("path", "idx", "start", "end", F.transform("said", lambda x: clean_text(x["text"])).alias("lines"))


def caption_lines(cues: DataFrame) -> DataFrame:
    """path, idx, t, text: one row for each line of each cue."""
    flat = cues.select("path", F.col("idx").alias("cue"), F.col("start").alias("t"), F.posexplode("lines").alias("line", "text"))
    return flat.select("path", (F.col("cue") * 1000 + F.col("line")).cast("long").alias("idx"), "t", "text")


def roster(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, district string, party string, term_start date, term_end date").option("header", True).csv(path)


def recording_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``recordings``: names of the recordings that their player links point to."""
    urls = F.transform(links(F.col(html)), lambda u: base64_url(F.nullif(F.regexp_extract(unescape_html(u), r"[?&]URL=([^&]+)", 1), F.lit(""))))
    names = F.transform(F.array_compact(urls), lambda u: file_stem(F.coalesce(F.nullif(F.regexp_extract(u, r"[?&]v=([^&]+)", 1), F.lit("")), u)))
    return pages.withColumn("recordings", F.array_distinct(F.filter(names, lambda n: n != "")))


class Pages(InputPartition):
    def __init__(self, first: int, step: int) -> None:
        self.first, self.step = first, step


class PagedReader(DataSourceReader):
    """Reads a paged collection to its end: every partition takes each ``partitions``-th page and goes on until
    a page is short. ``fetch(filter, order, top, skip)`` gives a page's rows; the filter and the order are the
    server's. With several partitions the order must tell all rows apart, or pages may overlap."""

    def __init__(self, schema, fetch, options: dict) -> None:
        self.schema, self.fetch = schema, fetch
        self.size, self.parts = int(options.get("pageSize", 1000)), int(options.get("partitions", 1))
        self.where, self.order = options.get("where", ""), options.get("orderBy", "")

    def partitions(self) -> list[Pages]:
        return [Pages(k, self.parts) for k in range(self.parts)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        page = partition.first
        while True:
            rows = list(self.fetch(self.where, self.order, self.size, page * self.size))
            for row in rows:
                yield tuple(row.get(f.name) for f in self.schema.fields)
            if len(rows) < self.size:
                return
            page += partition.step


class PushingReader(PagedReader):
    """A paged reader that hands conditions on single columns to the server, and leaves the others to Spark.

    ``columns`` has the server's name of each column that it can filter. The pushed text goes before the
    option ``where``, in the server's words (eq, gt, ge, lt, le, and).
    """

    WORDS = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}

    def __init__(self, schema, fetch, options: dict, columns: dict[str, str]) -> None:
        super().__init__(schema, fetch, options)
        self.columns = columns

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        said = []
        for condition in filters:
            text = self._text(condition)
            if text:
                said.append(text)
            else:
                yield condition
        self.where = " and ".join([*said, *([f"({self.where})"] if self.where and said else [self.where] if self.where else [])])

    def _text(self, condition: Filter) -> str | None:
        path = getattr(condition, "attribute", ())
        name = self.columns.get(path[0]) if len(path) == 1 else None
        if name is None:
            return None
        if isinstance(condition, IsNotNull):
            return f"{name} ne null"
        if isinstance(condition, In):
            each = [self._literal(v) for v in condition.value]
            return "(" + " or ".join(f"{name} eq {v}" for v in each) + ")" if each and all(each) else None
        word, value = self.WORDS.get(type(condition)), self._literal(getattr(condition, "value", None))
        return f"{name} {word} {value}" if word and value else None

    @staticmethod
    def _literal(value: object) -> str | None:
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, int):
            return str(value)
        if isinstance(value, datetime):
            return f"datetime'{value:%Y-%m-%dT%H:%M:%S}'" if not value.microsecond and value.tzinfo is None else None
        if isinstance(value, str):
            quoted = value.replace("'", "''")
            return f"datetime'{value}'" if re.fullmatch(r"\d{4}-\d\d-\d\d(T[\d:.]+)?", value) else f"'{quoted}'"
        return None


class CursorReader(DataSourceStreamReader):
    """The rows of a paged collection as they change: the offset is the greatest time stamp seen, as text.

    A batch holds the rows whose stamp lies behind the last offset and not behind the new one, so a batch that is
    repeated after a failure reads the same rows, and the cursor in the checkpoint moves when its batch is committed. Rows of
    one stamp come together; ``stamp`` is the server's name of it, ``field`` the row's.
    """

    def __init__(self, schema, fetch, options: dict, stamp: str, field: str) -> None:
        self.schema, self.fetch, self.stamp, self.field = schema, fetch, stamp, field
        self.size, self.start = int(options.get("pageSize", 1000)), options.get("start", "2025-04-01T00:00:00")

    def initialOffset(self) -> dict:  # noqa: N802
        self.at = self.start
        return {"cursor": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        now = getattr(self, "at", self.start)
        newest = list(self.fetch(self._after(now), f"{self.stamp} desc", 1, 0))
        self.at = newest[0][self.field] if newest else now
        return {"cursor": self.at}

    def _after(self, cursor: str) -> str:
        return f"{self.stamp} gt datetime'{cursor}'"

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(getattr(self, "at", self.start), end["cursor"])
        return [InputPartition((start["cursor"], end["cursor"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        start, end = partition.value
        page = PagedReader(self.schema, self.fetch, {"pageSize": self.size, "where": f"{self._after(start)} and {self.stamp} le datetime'{end}'", "orderBy": f"{self.stamp} asc"})
        yield from page.read(Pages(0, 1))

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def paged_source(name: str, schema: str, fetch, columns: dict[str, str] | None = None, stamp: str | None = None) -> type[DataSource]:
    """A data source class over a paged collection, for ``spark.dataSource.register``.

    With ``columns`` (the server's names of columns that it filters) conditions are pushed down, for which
    spark.sql.python.filterPushdown.enabled must be set; with ``stamp``, one of these columns, it can be read as a stream.
    """

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema):
            return PushingReader(schema, fetch, self.options, columns) if columns else PagedReader(schema, fetch, self.options)

        def streamReader(self, schema):  # noqa: N802
            if not stamp:
                raise ValueError(f"{name} has no time stamp to read on from")
            return CursorReader(schema, fetch, self.options, (columns or {}).get(stamp, stamp), stamp)

    return Paged


def modified_since(cursor: str) -> str:
    return f"EventLastModifiedUtc gt datetime'{cursor}'"


def date_window(start: str, end: str) -> str:
    return f"EventDate ge datetime'{start}' and EventDate lt datetime'{end}'"


ITEM = "EventItemId long, EventItemAgendaSequence int, EventItemMatterName string, EventItemTitle string"


def agenda_items(events: DataFrame, fetch: Callable[[int], list[dict]], key: str = "event_id", schema: str = ITEM) -> DataFrame:
    """The agenda items of each event (key), one row each, with ``ord``, the place that the source gives them.
    ``fetch(event)`` gives an event's items; it is called in the tasks, once for an event."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    kind = events.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(event, k, *[item.get(n) for n in names]) for event in frame[key].tolist() for k, item in enumerate(fetch(event))]
            yield pd.DataFrame(rows, columns=[key, "ord", *names], dtype=object)

    return events.select(key).distinct().mapInPandas(run, f"{key} {kind}, ord int, {schema}")


def first_items(items: DataFrame, key: str = "event_id", sequence: str = "EventItemAgendaSequence") -> DataFrame:
    """Each event's first item by its sequence; those without one come last, ties in the source's order."""
    at = F.struct(F.col(sequence).isNull(), F.col(sequence), F.col("ord"))
    return items.groupBy(key).agg(F.min_by(F.struct(*[c for c in items.columns if c != key]), at).alias("_i")).select(key, "_i.*")
