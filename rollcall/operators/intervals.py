"""Joins of intervals and points in time.

Every join has an equality on the group and on time buckets, so it is a hash or merge join and never
compares all rows of a group; a pair that meets in several buckets is counted once. Long intervals lie in
coarser buckets, so that none becomes more than a few hundred rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Levels of buckets, each STEP times as wide as the one before.
LEVELS, STEP = 3, 256


#: Where rows of the two sides of a join meet.
BUCKET = ["level", "at", "side"]


def _own(low: str, high: str, width: float) -> Column:
    """The first level at which an interval lies in at most STEP buckets, or the last one."""
    index = lambda c, w: F.floor(F.col(c) / w).cast("long")
    own = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        own = F.when(index(high, width * STEP**k) - index(low, width * STEP**k) < STEP, k).otherwise(own)
    return own


def top_level(width: float, *sides: tuple[DataFrame, str, str]) -> int:
    """The greatest level of the intervals of the sides (rows, low, high): rows need not be written for levels at which
    nothing lies. One small aggregate of each side; points have level 0."""
    tops = [rows.filter(F.col(low) <= F.col(high)).agg(F.max(_own(low, high, width)).alias("top")) for rows, low, high in sides if low != high]
    return max((r["top"] or 0 for r in reduce(DataFrame.union, tops).collect()), default=0) if tops else 0


def bucketed(rows: DataFrame, low: str, high: str, width: float, first: bool, top: int = LEVELS - 1) -> DataFrame:
    """``rows``, each once for every bucket (BUCKET) in which its interval may meet one of the other side of a join;
    one side is ``first``, and no interval of either is of a level above ``top``. Points have one column as both ends. Intervals of nulls or
    that end before they start have no bucket.

    An interval's level is the first at which it lies in at most STEP buckets (or the last). Two intervals meet at the
    higher of their levels: under side 0 if that is the level of the first one, else under side 1.
    """
    index = lambda c, w: F.floor(F.col(c) / w).cast("long")
    rows = rows.filter(F.col(low) <= F.col(high))
    if top == 0:
        at = index(low, width) if low == high else F.explode(F.sequence(index(low, width), index(high, width)))
        return rows.withColumn("level", F.lit(0)).withColumn("at", at).withColumn("side", F.lit(0))
    if low == high:
        rows = rows.withColumn("level", F.explode(F.array(*map(F.lit, range(top + 1)))))
        rows = rows.withColumn("at", index(low, width * F.pow(F.lit(float(STEP)), "level")))
        return rows.withColumn("side", F.when(F.col("level") > 0, int(first)).otherwise(0))
    wide = width * F.pow(F.lit(float(STEP)), "level")
    rows = rows.withColumn("_own", _own(low, high, width)).withColumn("level", F.explode(F.sequence("_own", F.lit(top))))
    rows = rows.withColumn("at", F.explode(F.sequence(index(low, wide), index(high, wide))))
    coarser = F.col("level") > F.col("_own")
    if first:
        return rows.withColumn("side", coarser.cast("int")).drop("_own")
    return rows.withColumn("side", F.explode(F.when(coarser | (F.col("level") == 0), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1))))).drop("_own")


def max_overlap(rows: DataFrame, turns: DataFrame, group: str, width: float = 60.0) -> DataFrame:
    """``rows`` (group, idx, t0, t1) with the label of the turn (group, ord, start, end, label) that
    overlaps it longest; then the longer turn, then the earlier ``ord``. Only rows with an overlap."""
    top = top_level(width, (rows, "t0", "t1"), (turns, "start", "end"))
    left = bucketed(rows.select(group, "idx", "t0", "t1"), "t0", "t1", width, True, top)
    right = bucketed(turns.select(group, "ord", "start", "end", "label"), "start", "end", width, False, top)
    both = left.join(right, [group, *BUCKET]).filter("t0 < end and t1 > start")
    shared = F.least("t1", "end") - F.greatest("t0", "start")
    best = F.max_by("label", F.struct(shared, F.col("end") - F.col("start"), -F.col("ord")))
    return both.groupBy(group, "idx").agg(best.alias("label"))


def nearest_midpoint(rows: DataFrame, turns: DataFrame, group: str, width: float = 600.0) -> DataFrame:
    """(group, idx, label) of the turn whose midpoint is nearest to the row's; ties go to the earlier
    ``ord``. The nearest before and after are looked up in sweeps over both tables, each over one stretch
    of ``width`` of a group; what lies in other stretches is carried over, one row for each stretch."""
    points = turns.groupBy(group, ((F.col("start") + F.col("end")) / 2).alias("mid")).agg(F.min(F.struct("ord", "label")).alias("turn"))
    points = points.select(group, "mid", F.lit(None).cast("long").alias("idx"), F.struct("mid", "turn").alias("here"))
    asked = rows.select(group, ((F.col("t0") + F.col("t1")) / 2).alias("mid"), F.col("idx").cast("long").alias("idx"), F.lit(None).cast(points.schema["here"].dataType).alias("here"))
    swept = points.unionByName(asked).withColumn("stretch", F.floor(F.col("mid") / width))

    known = F.when(F.col("here").isNotNull(), F.col("mid"))
    carried = swept.groupBy(group, "stretch").agg(F.max_by("here", known).alias("last"), F.min_by("here", known).alias("first"))
    up, down = (W.partitionBy(group).orderBy(o).rowsBetween(W.unboundedPreceding, -1) for o in (F.asc("stretch"), F.desc("stretch")))
    carried = carried.select(group, "stretch", F.last("last", ignorenulls=True).over(up).alias("earlier"), F.last("first", ignorenulls=True).over(down).alias("later"))

    # the way down runs in descending order: a frame that is open behind would be read again for every row
    up, down = (W.partitionBy(group, "stretch").orderBy(o, F.col("idx").isNotNull(), "idx").rowsBetween(W.unboundedPreceding, 0) for o in (F.asc("mid"), F.desc("mid")))
    swept = swept.withColumn("before", F.last("here", ignorenulls=True).over(up)).withColumn("after", F.last("here", ignorenulls=True).over(down))
    found = swept.filter("idx is not null").join(carried, [group, "stretch"])
    found = found.select(group, "idx", "mid", F.coalesce("before", "earlier").alias("before"), F.coalesce("after", "later").alias("after"))
    far = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(c)["mid"] - F.col("mid")).alias("d"), F.col(c)["turn"].alias("turn")))
    return found.select(group, "idx", F.least(far("before"), far("after"))["turn"]["label"].alias("label")).filter("label is not null")


def assign_labels(rows: DataFrame, turns: DataFrame, group: str, width: float = 60.0) -> DataFrame:
    """``rows`` with the label of longest overlap, else of the nearest midpoint. Turns that are empty or
    end before they start take no part."""
    turns = turns.filter("end > start")
    hit = max_overlap(rows, turns, group, width)
    miss = rows.join(hit, [group, "idx"], "left_anti")
    found = hit.unionByName(nearest_midpoint(miss, turns, group).select(group, F.col("idx").cast(rows.schema["idx"].dataType).alias("idx"), "label"))
    return rows.join(found, [group, "idx"], "left")


def contain(spans: DataFrame, points: DataFrame, group: str, keep: list[str], width: float = 600.0) -> DataFrame:
    """``spans`` (group, span, start, end) with ``points``: their rows (group, t, keep...) in
    start <= t < end, in order. Spans may overlap or leave gaps; those without points keep none."""
    top = top_level(width, (spans, "start", "end"))
    left = bucketed(spans.filter("start < end").select(group, "span", "start", "end"), "start", "end", width, True, top)
    right = bucketed(points.select(group, "t", *keep), "t", "t", width, False, top)
    inside = left.join(right, [group, *BUCKET]).filter("start <= t and t < end")
    nested = inside.groupBy(group, "span").agg(F.sort_array(F.collect_list(F.struct("t", *keep))).alias("points"))
    return spans.join(nested, [group, "span"], "left")


def override_ranges(rows: DataFrame, ranges: DataFrame, group: str, width: int = 64) -> DataFrame:
    """``rows`` (group, idx) with ``value`` of the last range (group, ord, low, high, value) over idx."""
    top = top_level(width, (ranges, "low", "high"))
    spread = bucketed(ranges.select(group, "ord", "low", "high", "value"), "low", "high", width, False, top)
    hit = bucketed(rows.select(group, "idx"), "idx", "idx", width, True, top).join(spread, [group, *BUCKET])
    last = hit.filter("idx between low and high").groupBy(group, "idx").agg(F.max_by("value", "ord").alias("value"))
    return rows.join(last, [group, "idx"], "left")


def fill_ranges(rows: DataFrame, ranges: DataFrame, group: str, value: str, width: int = 64) -> DataFrame:
    """``rows`` (group, idx, value): where the value is null or UNKNOWN, that of the first range (group, ord, low,
    high, value) over idx that has a known one; if all over it are UNKNOWN, that."""
    top = top_level(width, (ranges, "low", "high"))
    spread = bucketed(ranges.select(group, "ord", "low", "high", F.col("value").alias("_new")), "low", "high", width, False, top)
    hit = bucketed(rows.select(group, "idx"), "idx", "idx", width, True, top).join(spread, [group, *BUCKET]).filter("idx between low and high")
    first = hit.groupBy(group, "idx").agg(F.min_by("_new", F.struct(F.col("_new").eqNullSafe("UNKNOWN"), "ord")).alias("_new"))
    open_ = F.col(value).isNull() | (F.col(value) == "UNKNOWN")
    return rows.join(first, [group, "idx"], "left").withColumn(value, F.when(open_ & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(value))).drop("_new")


def first_within(events: DataFrame, candidates: DataFrame, group: str, tolerance: float) -> DataFrame:
    """(event, candidate): for each event (group, event, t) the candidate (group, candidate, t) that comes
    first in scan order of those at most ``tolerance`` away; not the nearest."""
    left = events.select(group, "event", F.col("t").alias("et"), F.explode(F.sequence(*(F.floor((F.col("t") + x) / tolerance).cast("long") for x in (-tolerance, tolerance)))).alias("bucket"))
    right = candidates.select(group, "candidate", F.col("t").alias("ct"), F.floor(F.col("t") / tolerance).cast("long").alias("bucket"))
    both = left.join(right, [group, "bucket"]).filter(F.abs(F.col("et") - F.col("ct")) <= tolerance)
    return both.groupBy("event").agg(F.min("candidate").alias("candidate"))
