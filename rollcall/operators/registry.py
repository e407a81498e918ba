"""The registry of meetings: selections, merges and its state machine.

Tables are rewritten, not updated in place: each operator gives the new table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby, islice
from operator import itemgetter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from rollcall.functions.text import blank_to_null, safe_key
from rollcall.functions.timeparse import registry_time
from rollcall.operators.graph import components, cut

STAGES = ("discover", "fetch", "prepare", "transcribe", "diarize", "name_speakers", "chapterize")
STATUS = tuple(f"{s}_status" for s in STAGES)
MAX_ATTEMPTS = 5

# Columns of the registry.
_TEXT = "viebit_filename viebit_hash viebit_pub_date body_name event_date event_time event_location event_last_modified_utc agenda_pdf_url minutes_pdf_url insite_url event_video_path agenda_status_name minutes_status_name meeting_type meeting_slug body_slug video_web_url event_topic".split()
REGISTRY = T.StructType(
    [T.StructField("meeting_key", T.StringType(), False), T.StructField("legistar_event_id", T.LongType()), T.StructField("legistar_event_guid", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in _TEXT]
    + [T.StructField("duration_seconds", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in STATUS]
    + [T.StructField(c, T.StringType()) for c in ("discovered_at", "fetched_at", "prepared_at", "created_at", "updated_at", "last_error")]
    + [T.StructField("process_attempts", T.LongType()), T.StructField("cost_usd", T.DoubleType())]
)
# What a stage's column holds once the stage is done, and before anything was done.
DONE = {
    "fetch_status": "fetched", "prepare_status": "prepared", "transcribe_status": "transcribed",
    "diarize_status": "diarized", "name_speakers_status": "named", "chapterize_status": "chapterized",
}
PRISTINE = {
    "fetch_status": ("pending",), "prepare_status": ("pending",), "transcribe_status": ("pending", "stubbed"),
    "diarize_status": ("pending", "stubbed"), "name_speakers_status": ("pending", "stubbed"), "chapterize_status": ("pending", "stubbed"),
}
DEFAULTS = {"discover_status": "discovered"} | {s: words[-1] for s, words in PRISTINE.items()} | {"process_attempts": 0}


def evolve(df: DataFrame, schema: T.StructType = REGISTRY) -> DataFrame:
    """The table under a newer schema: missing columns are added as nulls, defaults filled in."""
    out = df.sparkSession.createDataFrame([], schema).unionByName(df, allowMissingColumns=True)
    return out.fillna({k: v for k, v in DEFAULTS.items() if k in out.columns})


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Values of a unique column that occur more than once; nulls may repeat."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")


def one(df: DataFrame, key: str, value: object) -> DataFrame:
    """The row of a key; an error when it is read if there is none."""
    found = df.filter(F.col(key) == F.lit(value))
    check = F.assert_true(F.count("*") == 1, F.lit(f"no single row for {key} {value}"))
    return found.join(F.broadcast(found.agg(check.alias("_ok"))), how="inner").drop("_ok")


def done(stage: str, value: Column | None = None) -> Column:
    """Whether a stage is done, by its column or by a value of it; null is not."""
    return F.coalesce((F.col(stage) if value is None else value) == DONE[stage], F.lit(False))


def pristine(stage: str, value: Column | None = None) -> Column:
    return F.coalesce((F.col(stage) if value is None else value).isin(*PRISTINE[stage]), F.lit(False))


def candidates(df: DataFrame, previous: str | None, current: str | None, order: list[Column], limit: int | None = None) -> DataFrame:
    """Rows whose previous stage is done and whose current one is not, oldest first."""
    if previous:
        df = df.filter(done(previous))
    if current:
        df = df.filter(~done(current))
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def pending(df: DataFrame, floor: str, stages: list[str], day: Column, attempts: str = "process_attempts") -> DataFrame:
    """Rows on or after the floor (dates compare as text) with a stage to do and attempts left."""
    return df.filter((F.col(attempts) < MAX_ATTEMPTS) & (day >= floor) & reduce(lambda a, b: a | b, [~done(s) for s in stages]))


def parked(df: DataFrame, last_stage: str, attempts: str = "process_attempts") -> DataFrame:
    return df.filter((F.col(attempts) >= MAX_ATTEMPTS) & ~done(last_stage))


def publishable(df: DataFrame, stages: list[str], *named: str) -> DataFrame:
    """All stages done, and at least one of the columns neither null nor ''."""
    some = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != "", F.lit(False)) for c in named])
    return df.filter(reduce(lambda a, b: a & b, [done(s) for s in stages]) & some)


def matrix_json(df: DataFrame, *columns: str) -> DataFrame:
    """One compact JSON text per row for a fan-out."""
    return df.select(F.to_json(F.struct(*columns)).alias("item"))


def merged_status(stage: str, current: Column, incoming: Column) -> Column:
    """A done stage stays done; otherwise what comes in counts."""
    return F.when(done(stage, current) & ~done(stage, incoming), current).otherwise(incoming)


def merge_results(registry: DataFrame, results: DataFrame, key: str, stages: list[str], attempts: str, cost: str) -> DataFrame:
    """Registry after a feed of result rows (the key, ord and registry columns), last ``ord`` winning.

    Unknown keys are left out. A done stage never falls back, also between results of one key. Attempts: null keeps, 0
    resets, else the larger. A null cost keeps the present one. Other columns are overwritten, nulls too.
    """
    plain = [c for c in registry.columns if c != key and c not in (*stages, attempts, cost) and c in results.columns]
    kept = [c for c in registry.columns if c != key and c not in (*stages, attempts, cost) and c not in results.columns]
    last = lambda c: F.max_by(c, "ord").alias(c)
    since = F.max(F.when(F.col(attempts) == 0, F.col("ord"))).over(W.partitionBy(key))
    feed = results.withColumn("_since", since)
    highest = F.max(F.when(F.col("_since").isNull() | (F.col("ord") >= F.col("_since")), F.col(attempts)))
    feed = feed.groupBy(key).agg(
        *[last(c) for c in plain],
        *[F.when(F.max(done(s)), F.lit(DONE[s])).otherwise(F.max_by(s, "ord")).alias(s) for s in stages],
        highest.alias("_attempts"),
        F.max("_since").isNotNull().alias("_reset"),
        F.max_by(cost, F.when(F.col(cost).isNotNull(), F.col("ord"))).alias("_cost"),
        F.lit(True).alias("_hit"),
    )
    now, new = registry.alias("r"), feed.alias("f")
    hit = F.coalesce(F.col("f._hit"), F.lit(False))
    pick = {c: F.when(hit, F.col(f"f.{c}")).otherwise(F.col(f"r.{c}")) for c in plain} | {c: F.col(f"r.{c}") for c in kept}
    pick |= {s: F.when(hit, merged_status(s, F.col(f"r.{s}"), F.col(f"f.{s}"))).otherwise(F.col(f"r.{s}")) for s in stages}
    pick[attempts] = F.when(F.col("f._attempts").isNull(), F.col(f"r.{attempts}")).when(F.col("f._reset"), F.col("f._attempts")).otherwise(F.greatest(F.col("f._attempts"), F.col(f"r.{attempts}")))
    pick[cost] = F.coalesce(F.col("f._cost"), F.col(f"r.{cost}"))
    pick[key] = F.col(f"r.{key}")
    return now.join(new, F.col(f"r.{key}") == F.col(f"f.{key}"), "left").select(*[pick[c].alias(c) for c in registry.columns])


def upsert(target: DataFrame, source: DataFrame, key: str, sticky: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both by key: values of the source win unless null; sticky columns keep the target's."""
    t, s = target.alias("t"), source.alias("s")
    both = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    order = lambda c: ("t", "s") if c in sticky else ("s", "t")
    return both.select(*[F.coalesce(*[F.col(f"{side}.{c}") for side in order(c)]).alias(c) for c in target.columns])


def identify(incoming: DataFrame, registry: DataFrame, first: str, second: str, key: str) -> DataFrame:
    """``incoming`` with ``found``: the registry key that the first, else the second identifier has;
    and ``conflict``: whether both have one and they differ."""
    a = registry.filter(F.col(first).isNotNull()).select(first, F.col(key).alias("_a"))
    b = registry.filter(F.col(second).isNotNull()).select(second, F.col(key).alias("_b"))
    out = incoming.join(a, first, "left").join(b, second, "left")
    out = out.withColumn("found", F.coalesce("_a", "_b")).withColumn("conflict", F.coalesce(F.col("_a") != F.col("_b"), F.lit(False)))
    return out.drop("_a", "_b")


def resolve_conflicts(pairs: DataFrame, stages: list[str], columns: list[str], key: str) -> DataFrame:
    """One row of each pair (a: by event, b: by recording), and ``deleted``, the key of the other: a survives if all its stages
    are done and all of b's are untouched, else b. A stage of the other counts unless the survivor's is done and the
    other's is not; other columns fill nulls of the survivor."""
    keep_a = reduce(lambda x, y: x & y, [done(s, F.col(f"a.{s}")) & pristine(s, F.col(f"b.{s}")) for s in stages])
    side = lambda c: (F.when(keep_a, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")), F.when(keep_a, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")))
    value = lambda c: side(c)[0] if c == key else merged_status(c, *side(c)) if c in stages else F.coalesce(*side(c))
    return pairs.select(keep_a.alias("kept_event_row"), side(key)[1].alias("deleted"), *[value(c).alias(c) for c in columns])


def meeting_key(filename: Column, event_id: Column) -> Column:
    """The key of a new row: its recording's name, else its event's number; null without either."""
    named = F.when(blank_to_null(filename).isNotNull(), safe_key(F.regexp_replace(filename, r"\.mp4$", "")))
    return F.coalesce(named, F.concat(F.lit("event-"), event_id.cast("string")))


EVENT, FILE, KEY = "legistar_event_id", "viebit_filename", "meeting_key"


def _replay(rows: list[dict], columns: list[str]) -> list[dict]:
    """The registry rows of one component after its incoming rows, in order. A row has ``_ord`` (None: it is in
    the registry), ``_key`` (the key that a new row would get) and ``_now``."""
    table = {r[KEY]: {c: r[c] for c in columns} for r in rows if r["_ord"] is None}
    find = lambda c, v: next((r for r in table.values() if v not in (None, "") and r[c] == v), None)
    for new in sorted((r for r in rows if r["_ord"] is not None), key=lambda r: r["_ord"]):
        by_event, by_file = find(EVENT, new[EVENT]), find(FILE, new[FILE])
        if by_event and by_file and by_event is not by_file:
            stages = [s for s in DONE if s in columns]
            event_stays = all(by_event[s] == DONE[s] and by_file[s] in PRISTINE[s] for s in stages)
            row, other = (by_event, by_file) if event_stays else (by_file, by_event)
            for c in columns:
                if c in stages:
                    row[c] = row[c] if row[c] == DONE[c] and other[c] != DONE[c] else other[c]
                elif row[c] is None:
                    row[c] = other[c]
            del table[other[KEY]]
        else:
            row = by_event or by_file
        if row is None:
            row = {c: DEFAULTS.get(c) for c in columns}
            row[KEY] = new["_key"]
            row |= {c: new["_now"] for c in ("created_at", "discovered_at") if c in columns}
            if row[KEY] in table:
                raise ValueError(f"the key of a new row is taken: {row[KEY]}")
            table[row[KEY]] = row
            held: tuple[str, ...] = (KEY,)
        else:
            held = (KEY, "discovered_at") if row.get("discovered_at") else (KEY,)
        row |= {c: new[c] for c in columns if c not in held and new[c] is not None}
        row["updated_at"] = new["_now"]
    return list(table.values())


def upsert_batch(table: DataFrame, incoming: DataFrame, now: str, order: str = "ord") -> DataFrame:
    """The registry (columns as in REGISTRY, or some of them) after rows found by discovery, as if each
    were put in by itself in the order of ``order``, which must tell rows apart.

    A row is that of its event's number and that of its recording's name. If those are two rows they become one
    (see resolve_conflicts) and the other is deleted; if there is none, a row with defaults and a key of its own is made. Then
    values of the incoming row count unless null; discovered_at stays. Rows without either identifier are left out.
    A new row whose key is taken by one that it does not match is an error.

    What an incoming row can touch are the connected parts of the identifiers of the batch and of the registry rows that
    have them. Where a part is one row with all its identifiers, incoming rows of any number are
    summed up by their last values; other parts are replayed, each by one task. The rest of the registry passes by.
    """
    columns = table.columns
    rows = incoming.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in columns if c in incoming.columns], F.col(order).alias("_ord"))
    rows = table.limit(0).withColumn("_ord", F.lit(None).cast(incoming.schema[order].dataType)).unionByName(rows, allowMissingColumns=True)
    rows = rows.withColumns({FILE: blank_to_null(F.col(FILE)), "_key": F.coalesce(KEY, meeting_key(F.col(FILE), F.col(EVENT)))})
    if "discover_status" in columns:
        rows = rows.withColumn("discover_status", F.coalesce("discover_status", F.lit(DEFAULTS["discover_status"])))
    rows = rows.filter(F.col(EVENT).isNotNull() | F.col(FILE).isNotNull())
    key_node = lambda c: F.concat(F.lit("k:"), c)
    keys = [table.filter(F.col(c).isNotNull()).select(F.col(c).alias(c), key_node(F.col(KEY)).alias(f"_{k}")) for c, k in ((EVENT, "e"), (FILE, "f"))]
    rows = rows.join(keys[0], EVENT, "left").join(keys[1], FILE, "left")
    rows = rows.withColumn("_e", F.coalesce("_e", F.concat(F.lit("e:"), F.col(EVENT).cast("string")))).withColumn("_f", F.coalesce("_f", F.concat(F.lit("f:"), FILE)))
    fresh = ~F.coalesce(F.col("_e").startswith("k:") | F.col("_f").startswith("k:"), F.lit(False))
    rows = cut(rows.withColumn("_own", F.coalesce("_e", "_f")).withColumn("_new", fresh))
    ends = F.array(F.col("_f"), F.when(F.col("_new"), key_node(F.col("_key"))), F.col("_own"))
    parts = cut(components(rows.select("_own", F.explode(ends).alias("_end")), "_own", "_end"))
    rows = rows.join(parts.withColumnRenamed("node", "_own"), "_own")
    known = parts.filter(F.col("node").startswith("k:")).select(F.substr("node", F.lit(3)).alias(KEY), "component")
    touched = table.join(known, KEY)
    # parts in which every incoming row means the same row, whatever the order
    pair = F.struct(EVENT, FILE)
    own = touched.groupBy("component").agg(F.count("*").alias("_rows"), F.count(EVENT).alias("_events"), F.count(FILE).alias("_files"))
    alike = rows.groupBy("component").agg(F.min(pair).eqNullSafe(F.max(pair)).alias("_one"), F.min(F.col("_own").startswith("k:")).alias("_known"), F.min(F.coalesce(F.col("_f").startswith("k:"), F.lit(True))).alias("_filed"), F.max(~F.col("_new")).alias("_any"))
    whole = (F.col("_events") == 1) & (F.col("_files") == 1) & F.col("_known") & F.col("_filed")
    alone = (F.col("_rows") == 1) & ((F.col("_one") & F.col("_any")) | whole)
    kinds = cut(alike.join(own, "component", "left").select("component", F.when(F.col("_rows").isNull(), F.col("_one")).otherwise(alone).alias("_plain")))
    plain = _overlay(touched.join(kinds.filter("_plain"), "component").drop("_plain"), rows.join(kinds.filter("_plain"), "component"), columns, now)
    tangled = touched.withColumns({"_ord": F.lit(None).cast(rows.schema["_ord"].dataType), "_key": F.lit(None).cast("string")}).unionByName(rows.select(*touched.columns, "_ord", "_key"))
    tangled = tangled.join(kinds.filter("not _plain"), "component").withColumn("_now", F.lit(now))

    def work(batches: Iterator) -> Iterator:  # Arrow batches, in the order of the component
        import pyarrow as pa

        fields: list = []

        def each() -> Iterator[dict]:
            for batch in batches:
                fields[:] = [batch.schema.field(c) for c in columns]
                yield from batch.to_pylist()

        out = (r for _, group in groupby(each(), itemgetter("component")) for r in _replay(list(group), columns))
        while some := list(islice(out, 5000)):
            yield pa.RecordBatch.from_pylist(some, schema=pa.schema(fields))

    # many components a task, one of them at a time
    dealt = tangled.select("component", *columns, "_ord", "_key", "_now").repartition("component").sortWithinPartitions("component")
    replayed = dealt.mapInArrow(work, table.schema)
    rest = table.join(known.join(kinds, "component").select(KEY), KEY, "left_anti")
    return rest.select(*columns).unionByName(plain).unionByName(replayed)


def _overlay(present: DataFrame, rows: DataFrame, columns: list[str], now: str) -> DataFrame:
    """Rows of ``present``, or new ones with defaults, under the last values other than null of each component."""
    free = [c for c in columns if c not in (KEY, "updated_at", "created_at", "discovered_at")]
    stamps = [c for c in ("created_at", "discovered_at") if c in columns]
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_ord"))).alias(c)
    # a new row's stamps: the first row's, where it has them, else now; a later one overwrites all but discovered_at
    first = {c: F.min_by(F.struct(c), "_ord")[c].alias(f"_{c}") for c in stamps}
    found = [F.min_by("discovered_at", F.when(F.length("discovered_at") > 0, F.col("_ord"))).alias("_found")] if "discovered_at" in columns else []
    said = rows.groupBy("component").agg(*[last(c) for c in [*free, *stamps]], *first.values(), *found, F.min_by("_key", "_ord").alias("_key"))
    t, s = present.withColumn("_there", F.lit(True)).alias("t"), said.alias("s")
    both = s.join(t, F.col("s.component") == F.col("t.component"), "left")
    old = F.coalesce(F.col("t._there"), F.lit(False))
    pick = {c: F.coalesce(F.col(f"s.{c}"), F.when(old, F.col(f"t.{c}")).otherwise(F.lit(DEFAULTS.get(c)).cast(present.schema[c].dataType))) for c in free}
    pick[KEY] = F.coalesce(F.col(f"t.{KEY}"), F.col("s._key"))
    if "created_at" in columns:
        pick["created_at"] = F.coalesce("s.created_at", F.when(old, F.col("t.created_at")).otherwise(F.lit(now)))
    if "discovered_at" in columns:
        held = F.when(F.length("t.discovered_at") > 0, F.col("t.discovered_at"))
        pick["discovered_at"] = F.when(old, F.coalesce(held, "s._found", "s.discovered_at", "t.discovered_at")).otherwise(F.coalesce("s._discovered_at", F.lit(now)))
    if "updated_at" in columns:
        pick["updated_at"] = F.lit(now)
    return both.select(*[pick[c].alias(c) for c in columns])


def missing_results(expected: DataFrame, results: DataFrame, key: str, good: tuple[str, ...]) -> DataFrame:
    """Dispatched keys without a result, or with a status that is not good."""
    got = results.groupBy(key).agg(F.max("status").alias("status"))
    out = expected.select(key).distinct().join(got, key, "left")
    return out.filter(F.col("status").isNull() | ~F.col("status").isin(*good)).withColumn("problem", F.when(F.col("status").isNull(), "missing").otherwise("bad status"))


def reset(df: DataFrame, chosen: Column, stages: list[str], attempts: str, error: str) -> DataFrame:
    out = {s: F.when(chosen, F.lit(DEFAULTS.get(s, "pending"))).otherwise(F.col(s)) for s in stages}
    out |= {attempts: F.when(chosen, F.lit(0)).otherwise(F.col(attempts)), error: F.when(chosen, F.lit(None)).otherwise(F.col(error))}
    return df.withColumns(out)


def downgrade(df: DataFrame, artifacts: DataFrame, key: str, stage: str) -> DataFrame:
    """A done stage falls back to pending where its artifact is missing."""
    there = artifacts.select(key).distinct().withColumn("_there", F.lit(True))
    out = df.join(there, key, "left")
    return out.withColumn(stage, F.when(done(stage) & F.col("_there").isNull(), F.lit("pending")).otherwise(F.col(stage))).drop("_there")


def record_failure(df: DataFrame, failed: DataFrame, key: str, attempts: str, error: str) -> DataFrame:
    """Attempts and last error (2000 characters) after a run (key, message)."""
    out = df.join(failed.select(key, F.col("message").alias("_m")), key, "left")
    hit = F.col("_m").isNotNull()
    return out.withColumns({attempts: F.when(hit, F.col(attempts) + 1).otherwise(F.col(attempts)), error: F.when(hit, F.substring("_m", 1, 2000)).otherwise(F.col(error))}).drop("_m")


def union_by_priority(tables: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """All rows, of equal keys (letter case aside) the one from the first table, then by order."""
    every = reduce(lambda a, b: a.unionByName(b), [t.withColumn("priority", F.lit(i)) for i, t in enumerate(tables)])
    # a grouped minimum, so that a common key is combined before it is shuffled
    best = F.min_by(F.struct("*"), F.struct("priority", *order))
    return every.groupBy(F.lower(key).alias("_key")).agg(best.alias("_row")).select("_row.*")


def in_term(df: DataFrame, start: str, end: str, on: Column) -> DataFrame:
    """Rows valid on a date; a missing end counts as the earliest date, so an open term never holds."""
    first = F.lit("0001-01-01").cast("date")
    return df.filter((F.coalesce(F.col(start), first) <= on) & (F.coalesce(F.col(end), first) >= on))


def changed(old: DataFrame, new: DataFrame, key: str, *columns: str) -> DataFrame:
    """Rows of ``new`` that are not in ``old`` or differ in a column; null and '' count as equal."""
    o, n = old.alias("o"), new.alias("n")
    same = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"o.{c}").cast("string"), F.lit("")) == F.coalesce(F.col(f"n.{c}").cast("string"), F.lit("")) for c in columns])
    return n.join(o, F.col(f"o.{key}") == F.col(f"n.{key}"), "left").filter(F.col(f"o.{key}").isNull() | ~same).select("n.*")


def stamp(df: DataFrame, chosen: Column, at: Column, column: str = "updated_at") -> DataFrame:
    """Chosen rows marked with the moment of their change; others keep theirs."""
    return df.withColumn(column, F.when(chosen, at).otherwise(F.col(column)))


def retract(results: DataFrame, reset_rows: DataFrame, key: str) -> DataFrame:
    """Stored results without those of rows that were reset, so that the next merge does not bring them back."""
    return results.join(reset_rows.select(key).distinct(), key, "left_anti")


def stale_unmatched(df: DataFrame, floor: str, now: Column, days: int = 7) -> DataFrame:
    """Recordings on or after the floor that have had no event for more than ``days``; rows whose moment cannot
    be read are not among them. ``now`` is given, so that a rerun counts the same rows."""
    published, found = blank_to_null(F.col("viebit_pub_date")), F.col("discovered_at")
    day = F.coalesce(F.substring("viebit_pub_date", 1, 10), F.substring("discovered_at", 1, 10))
    since = registry_time(F.coalesce(published, found))
    alone = F.col("viebit_filename").isNotNull() & F.col("legistar_event_id").isNull()
    return df.filter(alone & (day >= floor) & (since < now - F.expr(f"INTERVAL {int(days)} DAYS")))


def backfill_topics(df: DataFrame, topics: DataFrame, limit: int = 60, key: str = "meeting_key") -> DataFrame:
    """``df`` with the topics (key, topic) of the first ``limit`` rows, by key, that have both identifiers and no
    topic: '' for a stated meeting and for a row whose items have none; a row not in ``topics`` could not be
    read and stays open. The limit is how much one run takes on; the next run goes on from there."""
    both = F.col("legistar_event_id").isNotNull() & F.col("viebit_filename").isNotNull() & F.col("event_topic").isNull()
    chosen = df.filter(both).select(key).orderBy(key).limit(limit).withColumn("_chosen", F.lit(True))
    out = df.join(chosen, key, "left").join(topics.select(key, F.coalesce("topic", F.lit("")).alias("_topic")), key, "left")
    found = F.when(F.col("meeting_type") == "STATED_MEETING", F.lit("")).otherwise(F.col("_topic"))
    return out.withColumn("event_topic", F.when(F.col("_chosen"), found).otherwise(F.col("event_topic"))).select(*df.columns)


def poll_outcome(status: Column, waited: Column, budget: float) -> Column:
    """done, failed, waiting, or pending: a job that outlasts the budget is no failure and takes no attempt."""
    failed = status.isin("FAILED", "TIMEOUT_EXCEEDED", "CANCELLED")
    return F.when(status == "SUCCESS", "done").when(failed, "failed").when(waited >= budget, "pending").otherwise("waiting")
