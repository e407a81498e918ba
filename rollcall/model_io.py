"""Boundaries to models: speech, diarisation and language. Engines are passed in; plans stay testable."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalar import round_seconds
from rollcall.functions.text import blank_to_null, clean_text, join_tokens, source_label
from rollcall.operators.sequence import fold_words
from rollcall.sources.readers import exists

Backend = Callable[[pd.DataFrame], list[dict]]


def call_model(requests: DataFrame, backend: Backend, schema: str, batch_rows: int = 64) -> DataFrame:
    """``backend`` over the rows of ``requests``, a small batch at a time; it gives dicts of ``schema``."""
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), batch_rows):
                rows = backend(frame.iloc[k : k + batch_rows])
                yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names)

    return requests.mapInPandas(run, schema)


def only_missing(requests: DataFrame, responses: DataFrame, key: str, params: str) -> DataFrame:
    """Requests whose stored response is missing or was made with other parameters."""
    return requests.join(responses.select(key, params), [key, params], "left_anti")


def answered(requests: DataFrame, backend: Backend, schema: str, folder: str, key: str, params: str, lots: int = 16) -> DataFrame:
    """The answers to all ``requests`` (key, params and what the backend reads), from a durable store where they are there.

    The store holds answers by key and by the hash of their parameters and input; ``schema``, of what the backend gives, has
    the key. Requests without an answer are asked in ``lots`` by a hash of the key, each of which is written when it is done: a run
    that is stopped has lost one lot at most, the next takes up the rest, and a request whose hash has changed is asked anew.
    """
    spark = requests.sparkSession
    others = sorted(c for c in requests.columns if c != key)
    asked = requests.withColumn("_hash", F.sha2(F.to_json(F.struct(*[F.col(c) for c in others]), {"ignoreNullFields": "false"}), 256)).withColumn("_lot", F.pmod(F.xxhash64(key), F.lit(lots)).cast("int"))
    kinds = {f.name: f.dataType.simpleString() for f in asked.schema}
    stored = f"{schema}, _hash string, _lot int"
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), 64):
                part = frame.iloc[k : k + 64]
                hashes = dict(zip(part[key], zip(part["_hash"], part["_lot"], strict=True), strict=True))
                rows = backend(part.drop(columns=["_hash", "_lot"]))
                yield pd.DataFrame([[*[r.get(n) for n in names], *hashes[r[key]]] for r in rows], columns=[*names, "_hash", "_lot"])

    def there() -> DataFrame:
        return spark.read.schema(stored).parquet(folder) if exists(spark, f"{folder}/_lot=*") else spark.createDataFrame([], stored)

    for lot in range(lots):
        missing = asked.filter(F.col("_lot") == lot).join(there().filter(F.col("_lot") == lot).select(key, "_hash"), [key, "_hash"], "left_anti")
        missing.select(*kinds).mapInPandas(run, stored).write.mode("append").partitionBy("_lot").parquet(folder)
    current = asked.select(key, "_hash")
    return there().join(current, [key, "_hash"]).select(*names)


SEGMENT = "meeting_key string, part int, t0 double, t1 double, text string, label string"


def segments(responses: DataFrame, unit: float = 1.0) -> DataFrame:
    """Canonical segments of vendors' responses (meeting_key, part, offset, suffix, segments array<struct<
    text, start, end, speaker_id>>): shifted by the part's offset, labels by its suffix; blank and empty
    ones go. ``unit``: the length of a vendor's time unit in seconds."""
    flat = responses.select("meeting_key", "part", "offset", "suffix", F.explode("segments").alias("s"))
    return _shifted(flat.select("meeting_key", "part", "offset", "suffix", (F.col("s.start") * unit).alias("t0"), (F.col("s.end") * unit).alias("t1"), F.col("s.text").alias("text"), F.col("s.speaker_id").alias("speaker")))


def _once(rows: DataFrame, kept: list[str], *columns: Column) -> DataFrame:
    """``kept`` and further columns, which a generator works out once a row: as plain columns they would be written into
    each later step that names them, and be worked out there again."""
    return rows.select(*kept, F.inline(F.array(F.struct(*columns))))


def _shifted(rows: DataFrame) -> DataFrame:
    key = ["meeting_key", "part", "offset", "suffix"]
    good = _once(rows.filter(F.col("t1") > F.col("t0")), [*key, "t0", "t1", "speaker"], clean_text(F.col("text")).alias("text")).filter("text <> ''")
    label = F.concat(F.coalesce(source_label(F.col("speaker")), F.lit("UNKNOWN")), F.coalesce("suffix", F.lit("")))
    shift = lambda c: round_seconds(F.col(c) + F.col("offset"))
    out = _once(good, ["meeting_key", "part", "text", "suffix", "speaker"], shift("t0").alias("t0"), shift("t1").alias("t1")).filter("t1 > t0")
    return out.select("meeting_key", "part", "t0", "t1", "text", label.alias("label"))


_TIMES = "text: string, start: string, end: string, start_time: string, end_time: string, speaker_id: string, speaker: string, speaker_label: string"
_WORD = f"struct<{_TIMES}, word: string, type: string>"
_ITEM = f"struct<{_TIMES}, transcript: string, words: array<{_WORD}>>"


def vendor_segments(replies: DataFrame, items: str, unit: float = 1.0, by_words: bool = False) -> DataFrame:
    """Canonical segments of the replies (meeting_key, part, offset, suffix, body) of a service whose JSON lists
    them under ``items``: segments or sentences in seconds, utterances in thousandths (``unit``).

    An item has its text, times and speaker under any of the usual names; one without times takes those of its
    first and last word, one without a text its words. With ``by_words`` items are cut anew at the pauses of
    their words. A reply without a usable item is made from its words; blank and empty segments go.
    """
    key = ["meeting_key", "part", "offset", "suffix"]
    body = F.from_json("body", f"struct<{items}: array<{_ITEM}>, words: array<{_WORD}>>")
    same = ["meeting_key", "part"]
    at = lambda x, name: F.coalesce(x[name], x[f"{name}_time"]).try_cast("double") * unit
    who = lambda x: F.coalesce(source_label(x["speaker_id"], x["speaker"], x["speaker_label"]), F.lit("UNKNOWN"))
    said = lambda w: clean_text(F.coalesce(blank_to_null(w["text"]), w["word"]))
    sound = lambda w: (said(w) != "") & ~F.lower(F.coalesce(w["type"], F.lit("word"))).eqNullSafe("spacing") & (at(w, "end") > at(w, "start"))

    timed = lambda w: (at(w, "start").alias("t0"), at(w, "end").alias("t1"), said(w).alias("word"))

    def cut(words: DataFrame) -> DataFrame:
        made = fold_words(words, [*key, "item"])
        return made.select(*key, "t0", "t1", join_tokens(F.split("text", " ")).alias("text"), "speaker")

    def itemised(replies: DataFrame) -> DataFrame:
        item = F.col("i")
        rows = replies.select(*key, body.alias("b")).select(*key, F.posexplode(f"b.{items}").alias("item", "i")).filter("i is not null")
        own = F.filter(F.coalesce(item["words"], F.array().cast(f"array<{_WORD}>")), sound)
        rows = _once(rows, [*key, "item", "i"], own.alias("_w"), clean_text(F.coalesce(blank_to_null(item["text"]), item["transcript"])).alias("_said"))
        first, last = F.get("_w", F.lit(0)), F.get("_w", F.size("_w") - 1)
        text = F.when(F.col("_said") != "", F.col("_said")).when(F.size("_w") > 0, join_tokens(F.transform("_w", said))).otherwise("")
        whole = _once(rows, key, F.coalesce(at(item, "start"), at(first, "start")).alias("t0"), F.coalesce(at(item, "end"), at(last, "end")).alias("t1"), text.alias("text"), who(item).alias("speaker"))
        whole = whole.filter((F.col("text") != "") & (F.col("t1") > F.col("t0")))
        if by_words:
            each = rows.select(*key, "item", who(item).alias("speaker"), F.posexplode("_w").alias("idx", "w"))
            parted = cut(each.select(*key, "item", "idx", "speaker", *timed(F.col("w"))))
            whole = parted.unionByName(whole.join(parted.select(*same).distinct(), same, "left_anti"))
        return whole

    # a reply has words of its own only where its text has that name, or signs by number; others are not read for it,
    # and which of them have usable items is asked of no other replies
    wordy = replies.filter(F.contains("body", F.lit("words")) | F.contains("body", F.lit("\\u")))
    usable = itemised(replies.join(wordy.select(*same).distinct(), same, "left_semi")).select(*same).distinct()
    loose = wordy.select(*key, body.alias("b")).join(usable, same, "left_anti").select(*key, F.posexplode("b.words").alias("idx", "w")).filter(sound(F.col("w")))
    loose = cut(loose.select(*key, F.lit(0).alias("item"), "idx", who(F.col("w")).alias("speaker"), *timed(F.col("w"))))
    return _shifted(itemised(replies).unionByName(loose))


def echo_backend(frame: pd.DataFrame) -> list[dict]:
    """Deterministic stand-in: each request answers with its own key and text."""
    return [{"key": k, "reply": str(t).upper()} for k, t in zip(frame["key"], frame["text"], strict=True)]
