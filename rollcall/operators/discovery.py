"""Discovery: events and recordings found by different sources, brought together in the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalar import meeting_type_from_event
from rollcall.functions.text import blank_to_null, file_stem, room_prefix, slug, time_slug
from rollcall.functions.timeparse import event_time, minutes_apart, recording_time
from rollcall.operators.graph import cut
from rollcall.operators.registry import upsert_batch

# Words of a place, all of which must be in it, and the rooms that a recording made there is named after.
ROOMS = (
    (("chambers",), ("NYCC-PV-CH-CHA",)),
    (("committee room", "city hall"), ("NYCC-PV-CH-COM",)),
    (("250 broadway",), ("NYCC-250-8-1", "NYCC-250-8-2", "NYCC-250-8-3")),
)
#: A body without a name.
NO_BODY = "new-york-city-council"
TOLERANCE = 150


def rooms_of(location: Column) -> Column:
    """Names of the rooms that a place may mean; none if it tells nothing."""
    low = F.lower(location)
    found = []
    for words, rooms in ROOMS:
        holds = F.lit(True)
        for w in words:
            holds = holds & F.contains(low, F.lit(w))
        found.append(F.when(holds, F.array(*map(F.lit, rooms))))
    return F.flatten(F.array_compact(F.array(*found)))


def plausible(recording: Column, date: Column, time: Column, location: Column, minutes: int = TOLERANCE) -> Column:
    """Whether a recording can be that of an event: its room, if the place tells one, and its start within ``minutes``."""
    rooms = rooms_of(location)
    near = minutes_apart(recording_time(recording), event_time(date, time)) <= minutes
    return F.coalesce(near & ((F.size(rooms) == 0) | F.array_contains(rooms, room_prefix(recording))), F.lit(False))


def first_free(pairs: DataFrame) -> DataFrame:
    """(event, candidate) such as events get them that choose one after the other, in the order of ``event``, each the first
    of its candidates (in the order of ``candidate``) that is still free; ``pairs`` has what each may choose.

    Every event asks for its first candidate, which keeps the first event that asks; the others ask for their next, until nobody is
    turned away. As all candidates prefer the same events this ends where the choice in turn ends, after a few rounds
    over all events at once.
    """
    left = cut(pairs.select("event", "candidate").distinct())
    while True:
        asked = left.groupBy("event").agg(F.min("candidate").alias("candidate"))
        kept = asked.groupBy("candidate").agg(F.min("event").alias("event"))
        lost = cut(asked.join(kept, ["event", "candidate"], "left_anti"))
        if lost.isEmpty():
            return asked
        left = cut(left.join(lost, ["event", "candidate"], "left_anti"))


def backstop(events: DataFrame, recordings: DataFrame, minutes: int = TOLERANCE) -> DataFrame:
    """(event, candidate) for events (event, date, time, location) without a recording of their own: each in its turn gets
    the first recording (candidate, name) of its room that starts within ``minutes`` and that none before it got."""
    seconds = lambda c: F.unix_micros(c) / 1_000_000
    everywhere = F.array(F.lit("*"))
    rooms = rooms_of(F.col("location"))
    asked = events.select("event", seconds(event_time(F.col("date"), F.col("time"))).alias("t"), F.explode(F.when(F.size(rooms) > 0, rooms).otherwise(everywhere)).alias("room")).filter("t is not null")
    there = recordings.select("candidate", seconds(recording_time(F.col("name"))).alias("t"), F.explode(F.array(room_prefix(F.col("name")), F.lit("*"))).alias("room")).filter("t is not null")
    return first_free(within(asked, there, "room", 60.0 * minutes))


def within(left: DataFrame, right: DataFrame, group: str, tolerance: float) -> DataFrame:
    """All pairs (event, candidate) of a group whose times are at most ``tolerance`` apart; joined by time buckets."""
    near = lambda x: F.floor((F.col("t") + x) / tolerance).cast("long")
    a = left.select(group, "event", F.col("t").alias("_a"), F.explode(F.sequence(near(-tolerance), near(tolerance))).alias("_bucket"))
    b = right.select(group, "candidate", F.col("t").alias("_b"), near(0.0).alias("_bucket"))
    return a.join(b, [group, "_bucket"]).filter(F.abs(F.col("_a") - F.col("_b")) <= tolerance).select("event", "candidate")


def event_rows(events: DataFrame) -> DataFrame:
    """Registry columns of events (event_id, event_guid, last_modified_utc, body_name, event_date, event_time, location, agenda_pdf_url,
    minutes_pdf_url, insite_url, video_path, agenda_status_name, minutes_status_name, ord), and ord."""
    body = F.coalesce(slug(F.col("body_name")), F.lit(NO_BODY))
    day, at = F.substring("event_date", 1, 10), time_slug(F.coalesce("event_time", F.lit("")))
    names = {"legistar_event_id": "event_id", "legistar_event_guid": "event_guid", "event_last_modified_utc": "last_modified_utc", "event_location": "location", "event_video_path": "video_path"}
    same = ("body_name", "event_date", "event_time", "agenda_pdf_url", "minutes_pdf_url", "insite_url", "agenda_status_name", "minutes_status_name", "ord")
    return events.select(
        *[F.col(b).alias(a) for a, b in names.items()], *same,
        meeting_type_from_event(F.coalesce("body_name", F.lit("")), F.col("agenda_status_name"), F.col("minutes_status_name")).alias("meeting_type"),
        F.when(blank_to_null(F.col("event_date")).isNotNull(), F.concat_ws("-", day, blank_to_null(at), blank_to_null(body))).alias("meeting_slug"),
        body.alias("body_slug"), F.lit("discovered").alias("discover_status"),
    )


def discover(table: DataFrame, events: DataFrame, details: DataFrame, now: str) -> DataFrame:
    """The registry after a batch of events (see ``event_rows``), each with its recording where there is one.

    The recording is the one that the event's video path names, else the one that its page names (``details``: event_id,
    filename; pages that could not be read are simply not there), each only if it is plausible; else the backstop: the first
    recording of the registry that has no event, of the event's room and time. A recording belongs to one event, the first.
    """
    rows = event_rows(events)
    found = details.groupBy(F.col("event_id").alias("legistar_event_id")).agg(F.min("filename").alias("_page"))
    rows = rows.join(found, "legistar_event_id", "left")
    fits = lambda c: F.when(plausible(c, F.col("event_date"), F.col("event_time"), F.col("event_location")), c)
    rows = cut(rows.withColumn("viebit_filename", F.coalesce(fits(blank_to_null(file_stem(F.col("event_video_path")))), fits(F.col("_page")))).drop("_page"))
    claimed = rows.filter("viebit_filename is not null").select("viebit_filename").distinct()
    free = table.filter("viebit_filename is not null and legistar_event_id is null").join(claimed, "viebit_filename", "left_anti")
    free = free.select(F.struct("meeting_key", "viebit_filename").alias("candidate"), F.col("viebit_filename").alias("name"))
    # an event that the registry already knows with a recording needs none
    known = table.filter("legistar_event_id is not null and viebit_filename is not null").select("legistar_event_id")
    alone = rows.filter("viebit_filename is null").join(known, "legistar_event_id", "left_anti")
    asking = alone.select(F.struct("ord", "legistar_event_id").alias("event"), F.col("event_date").alias("date"), F.col("event_time").alias("time"), F.col("event_location").alias("location"))
    given = backstop(asking, free).select(F.col("event.ord").alias("ord"), F.col("candidate.viebit_filename").alias("_given"))
    rows = rows.join(given, "ord", "left").withColumn("viebit_filename", F.coalesce("viebit_filename", "_given")).drop("_given")
    return upsert_batch(table, rows, now)
