"""Operators that depend on the order of rows inside a group.

What windows can say is said with windows. Folds whose state depends on what they emitted run once per
group in Python over that group's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rollcall.functions.text import clean_text, introduced_names
from rollcall.functions.timeparse import seconds_to_clock
from rollcall.operators.intervals import BUCKET, bucketed, top_level
from rollcall.operators.segments import TurnFold, WordFold, fold_segments


def normalize_utterances(rows: DataFrame, group: str, gap: float, least: float) -> DataFrame:
    """``rows`` (group, idx, t0, t1, text): the end is t1, else the next start, else t0 + gap; an end not
    after the start becomes max(t0 + least, next start). Blank texts go after the next start is taken."""
    by = W.partitionBy(group).orderBy("idx")
    rows = rows.withColumn("_next", F.coalesce(F.lead("t0").over(by), F.col("t0") + gap))
    rows = rows.withColumn("t1", F.coalesce(F.nullif("t1", F.lit(0)), "_next"))
    rows = rows.withColumn("t1", F.when(F.col("t1") <= F.col("t0"), F.greatest(F.col("t0") + least, "_next")).otherwise(F.col("t1")))
    return rows.withColumn("text", clean_text(F.col("text"))).filter("text <> ''").drop("_next")


def increasing(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value is above every earlier one of the group."""
    before = F.max(value).over(W.partitionBy(group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("_top", before).filter(F.col("_top").isNull() | (F.col(value) > F.col("_top"))).drop("_top")


def chapter_ends(rows: DataFrame, group: str, start: str, duration: str, end: str | None = None) -> DataFrame:
    """End of each chapter: its own if positive, else the next start, else the duration; at least 1 on."""
    following = F.lead(start).over(W.partitionBy(group).orderBy(start, "idx"))
    own = [F.nullif(F.col(end), F.lit(0))] if end else []
    return rows.withColumn("end_sec", F.greatest(F.col(start) + 1, F.coalesce(*own, following, F.col(duration))))


def first_appearance(rows: DataFrame, group: str, label: str, order: list[str]) -> DataFrame:
    """``rows`` with ``number``: 0, 1, 2 ... by the first row of each label in the group."""
    first = F.min(F.struct(*order)).over(W.partitionBy(group, label))
    return rows.withColumn("_first", first).withColumn("number", F.dense_rank().over(W.partitionBy(group).orderBy("_first")) - 1).drop("_first")


def first_of_each(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")


def label_evidence(rows: DataFrame, group: str, label: str) -> DataFrame:
    """For each label of a group (idx, t0, t1 in ms): n, ms, first_idx, last_idx, and its share of the group's time
    in hundredths of a per cent."""
    took = F.greatest(F.col("t1") - F.col("t0"), F.lit(0))
    out = rows.groupBy(group, label).agg(F.count("*").alias("n"), F.sum(took).cast("long").alias("ms"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))
    return out.withColumn("share_bp", F.floor(F.col("ms") * 10000 / F.nullif(F.sum("ms").over(W.partitionBy(group)), F.lit(0))).cast("long"))


def top_values(rows: DataFrame, group: str, value: str, order: str, most: int = 3) -> DataFrame:
    """The ``most`` commonest values of each group with n and rank; of equally common ones those that come first."""
    n = rows.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), "_first"))
    return n.withColumn("rank", rank).filter(F.col("rank") <= most).drop("_first")


def named_labels(rows: DataFrame, known: DataFrame, label: str, name: str = "UNKNOWN", confidence: float = 0.35) -> DataFrame:
    """``rows`` with the speaker and confidence of their label in ``known`` (label, name, c); others are ``name``."""
    out = rows.join(known.withColumnRenamed("label", label), label, "left")
    return out.withColumn("speaker", F.coalesce("name", F.lit(name))).withColumn("confidence", F.coalesce("c", F.lit(confidence))).drop("name", "c")


def verification_candidates(rows: DataFrame, known: DataFrame, group: str, label: str, snippet: str, telling: Column) -> DataFrame:
    """Labels of ``rows`` (group, idx) that are not ``known`` (label), each with its number of rows, its first row, an id
    in the order of first rows, and a snippet: that of its last ``telling`` row, else of its first."""
    out = rows.join(known, label, "left_anti").groupBy(group, F.col(label).alias("speaker")).agg(
        F.min("idx").alias("first_index"), F.count("*").alias("n"), F.coalesce(F.max_by(snippet, F.when(telling, F.col("idx"))), F.min_by(snippet, "idx")).alias("snippet")
    )
    return out.withColumn("id", F.format_string("v%03d", F.row_number().over(W.partitionBy(group).orderBy("first_index"))))


def silence_split(rows: DataFrame, group: str, at: str, order: list[str]) -> DataFrame:
    """split: the middle of the pause between two rows that is nearest to the middle of the group."""
    by = W.partitionBy(group)
    middle = (F.col(at) + F.lead(at).over(by.orderBy(*order))) / 2
    gaps = rows.select(group, middle.alias("mid"), ((F.min(at).over(by) + F.max(at).over(by)) / 2).alias("target")).filter("mid is not null")
    return gaps.groupBy(group).agg(F.min_by("mid", F.struct(F.abs(F.col("mid") - F.col("target")), "mid")).alias("split"))


def changes(rows: DataFrame, group: str, label: str) -> DataFrame:
    by = W.partitionBy(group).orderBy("idx")
    return rows.withColumn("starts_run", ~F.col(label).eqNullSafe(F.lag(label).over(by))).withColumn("ends_run", ~F.col(label).eqNullSafe(F.lead(label).over(by)))


def context(rows: DataFrame, group: str, value: str, before: int, after: int) -> Column:
    return F.collect_list(F.col(value)).over(W.partitionBy(group).orderBy("idx").rowsBetween(-before, after))


def run_ahead(rows: DataFrame, group: str, label: str, value: str, limit: int = 5) -> DataFrame:
    """``run``: the row's value and those after it up to ``limit``, as long as the label stays."""
    ahead = F.collect_list(F.struct(F.col(label).alias("label"), F.col(value).alias("value"))).over(W.partitionBy(group).orderBy("idx").rowsBetween(0, limit - 1))
    rows = rows.withColumn("_ahead", ahead)
    stop = F.array_position(F.transform("_ahead", lambda x: ~x["label"].eqNullSafe(F.col(label))), True).cast("int")
    return rows.withColumn("run", F.transform(F.slice("_ahead", F.lit(1), F.when(stop > 0, stop - 1).otherwise(F.size("_ahead"))), lambda x: x["value"])).drop("_ahead")


def sample_indices(interesting: Column, n: Column, most: int = 4, take: int = 8) -> Column:
    """Up to ``take`` of the indices 0 to n - 1, in order: the first ``most`` interesting ones, the first and the
    last, evenly spaced ones, and then from the start what is missing."""
    every = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)).cast("int"))
    wanted = F.concat(F.slice(interesting, 1, most).cast("array<int>"), F.array(F.lit(0), F.greatest(n - 1, F.lit(0)).cast("int")), evenly_spaced(n, take), every)
    return F.when(n > 0, F.array_sort(F.slice(F.array_distinct(wanted), 1, take))).otherwise(F.array().cast("array<int>"))


def other_speaker_near(rows: DataFrame, group: str, label: str, reach: int = 2) -> Column:
    """Whether one of the ``reach`` rows before or after has another label."""
    near = F.collect_set(F.coalesce(F.col(label), F.lit(""))).over(W.partitionBy(group).orderBy("idx").rowsBetween(-reach, reach))
    return F.size(near) > 1


def last_end(rows: DataFrame, group: str) -> DataFrame:
    """Latest end of each group's rows (t0, t1); a row without an end counts by its start, else as 0."""
    return rows.groupBy(group).agg(F.greatest(F.max(F.coalesce(F.nullif("t1", F.lit(0)), F.nullif("t0", F.lit(0)), F.lit(0)).cast("double")), F.lit(0.0)).alias("last_end"))


def merge_parts(segments: DataFrame, group: str) -> DataFrame:
    """Segments (group, part, ord, t0, t1) of all parts numbered by time; ties stay in the order of parts."""
    return segments.withColumn("idx", F.row_number().over(W.partitionBy(group).orderBy("t0", "t1", "part", "ord")) - 1)


def evenly_spaced(n: Column, take: int) -> Column:
    """Up to ``take`` indices from 0 to n - 1, evenly spaced, half to even."""
    spread = F.transform(F.sequence(F.lit(0), F.lit(take - 1)), lambda i: F.bround(i * (n - 1) / F.lit(float(take - 1))).cast("int"))
    return F.when(n <= take, F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)).cast("int"))).otherwise(F.array_distinct(spread))


def number_repeats(rows: DataFrame, group: list[str], key: str, order: list[str]) -> DataFrame:
    """``unique_key``: the key, for its second row in the group key-2, then key-3 ..."""
    n = F.row_number().over(W.partitionBy(*group, key).orderBy(*order))
    return rows.withColumn("_n", n).withColumn("unique_key", F.when(F.col("_n") == 1, F.col(key)).otherwise(F.concat_ws("-", key, "_n"))).drop("_n")


def starts_to_ranges(starts: DataFrame, group: str, last: str) -> DataFrame:
    """Ranges from starts: each ends before the next start, the last one at ``last``."""
    following = F.lead("start_index").over(W.partitionBy(group).orderBy("start_index")) - 1
    return starts.withColumn("end_index", F.coalesce(following, F.col(last)))


def fixed_chunks(rows: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    return rows.withColumn("chunk", F.floor((F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1) / size).cast("int"))


def split_votes(chapters: DataFrame, items: DataFrame, group: str, width: float = 600.0) -> DataFrame:
    """Vote chapters (group, idx, kind, start, end) with at least two items (group, t) from start - 3 to the
    end become one row per item, up to the next item or the end; other chapters stay."""
    votes = chapters.filter(F.col("kind").isin("VOTE", "VOICE_VOTE") & (F.col("end") > F.col("start") - 3))
    votes = votes.withColumn("_low", F.col("start") - 3)
    top = top_level(width, (votes, "_low", "end"))
    spread = bucketed(votes, "_low", "end", width, True, top)
    at = bucketed(items.select(group, "t"), "t", "t", width, False, top)
    inside = spread.join(at, [group, *BUCKET]).filter("t >= start - 3 and t < end")
    by = W.partitionBy(group, "idx")
    inside = inside.withColumn("n", F.count("*").over(by)).filter("n >= 2").withColumn("next", F.lead("t").over(by.orderBy("t")))
    parts = inside.select(group, "idx", F.lit("VOICE_VOTE").alias("kind"), F.col("t").alias("start"), F.greatest(F.col("t") + 1, F.coalesce("next", "end")).alias("end"))
    gone = parts.select(group, "idx").distinct()
    return chapters.join(gone, [group, "idx"], "left_anti").select(group, "idx", "kind", "start", "end").unionByName(parts)


def prefix_budget(rows: DataFrame, size: str, age: str, budget: int, oldest: int, order: list[Column]) -> DataFrame:
    """Rows from the newest on, up to the first that is too old or no longer fits the budget.

    Rows are summed by age first, so that the running sum over all ages works on few rows.
    """
    per_age = rows.groupBy(age).agg(F.sum(size).alias("_sum"))
    ahead = W.orderBy(age).rowsBetween(W.unboundedPreceding, -1)
    per_age = per_age.filter(F.col(age) <= oldest).withColumn("_before", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).filter(F.col("_before") < budget)
    inner = F.sum(size).over(W.partitionBy(age).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    placed = rows.join(F.broadcast(per_age.select(age, "_before")), age).withColumn("_total", F.col("_before") + inner)
    return placed.filter(F.col("_total") <= budget).drop("_before", "_total")


def fixed_parts(duration: Column, part: float) -> Column:
    """array<struct<index, offset, end, suffix>> of equal parts; a rest of half a second is none."""
    n = F.greatest(F.ceil((duration - 0.5) / part), F.lit(0)).cast("int")
    one = lambda i: F.struct(
        i.alias("index"), ((i - 1) * part).alias("offset"), F.least(i * part, duration).alias("end"),
        F.when(i == 1, "").otherwise(F.concat(F.lit("_part"), i.cast("string"))).alias("suffix"),
    )
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), one)).otherwise(F.array().cast("array<struct<index:int,offset:double,end:double,suffix:string>>"))


def pair_markers(rows: DataFrame, group: str, kind: str, at: str, last: str) -> DataFrame:
    """Intervals from start markers to the following end marker, else to ``last``."""
    by = W.partitionBy(group).orderBy(at, kind)
    rows = rows.withColumn("_kind", F.lead(kind).over(by)).withColumn("_at", F.lead(at).over(by)).filter(F.col(kind) == "start")
    return rows.select(group, F.col(at).alias("start"), F.when(F.col("_kind") == "end", F.col("_at")).otherwise(F.coalesce("_at", F.col(last))).alias("end"))


# Words that tell that somebody is introduced, and those that tell a panel.
HINT_WORDS = ("MY NAME IS", "I'M ", "I AM ", "CALL THE", "PANEL", "FROM THE", "GO TO ZOOM")
PANEL_WORDS = ("CALL THE", "PANEL", "GO TO ZOOM")


def speaker_hints(rows: DataFrame, group: str, stop_words: tuple[str, ...] = (), most: int = 160) -> DataFrame:
    """(group, place, hint): lines that tell where a speaker of the rows (group, idx, t0, text) may be named, or a panel
    introduced. A row with such words is read with the three rows behind it; a name, or the beginning of a panel's words, counts
    where it comes first, and the first ``most`` of a group are kept, as a prompt has room for so many."""
    by = W.partitionBy(group).orderBy("idx")
    said = F.coalesce("text", F.lit(""))
    # a row behind the last one adds nothing, not even a space
    window = F.concat_ws(" ", said, *[F.lead(said, k).over(by) for k in (1, 2, 3)])
    has = lambda c, words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.upper(c), w))
    near = rows.select(group, "idx", "t0", said.alias("_said"), window.alias("_window")).filter(has(F.col("_said"), HINT_WORDS))
    near = near.withColumn("_names", introduced_names(F.col("_window"), stop_words))
    name = F.transform("_names", lambda n: F.struct(F.lower(n).alias("key"), F.concat(F.lit("possible named speaker "), n).alias("what")))
    panel = F.when(has(F.col("_said"), PANEL_WORDS), F.array(F.struct(F.lower(F.substring("_window", 1, 120)).alias("key"), F.lit("possible panel introduction").alias("what"))))
    each = near.select(group, "idx", "t0", "_window", F.posexplode(F.when(F.size("_names") > 0, name).otherwise(panel)).alias("_k", "_h"))
    first = F.row_number().over(W.partitionBy(group, "_h.key").orderBy("idx", "_k"))
    each = each.withColumn("_first", first).filter("_first = 1").withColumn("place", F.row_number().over(W.partitionBy(group).orderBy("idx", "_k"))).filter(F.col("place") <= most)
    line = F.format_string("[%d] %s: %s | %s", F.col("idx").cast("long"), seconds_to_clock(F.col("t0")), F.col("_h.what"), F.substring("_window", 1, 220))
    return each.select(group, "place", line.alias("hint"))


# Folds


def fold(rows: DataFrame, group: list[str], order: list[str], schema: str, step: Callable[[pd.DataFrame], Iterable[tuple]]) -> DataFrame:
    """One pass of ``step`` over each group in order; a task holds one group at a time."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    ddl = ", ".join(f"{g} {kinds[g]}" for g in group) + ", " + schema
    names = [x.split()[0] for x in schema.split(", ")]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(list(step(frame.sort_values(order, kind="stable"))), columns=names)
        for name, value in zip(group, key, strict=True):
            out.insert(0, name, value)
        return out[[*group, *names]]

    return rows.groupBy(*group).applyInPandas(run, ddl)


def drop_rollup(rows: DataFrame, group: str, look_back: int = 8) -> DataFrame:
    """Caption lines (group, idx, text) that are not among the last ``look_back`` lines kept."""

    def step(frame: pd.DataFrame) -> Iterable[tuple]:
        kept: list[str] = []
        for idx, text in zip(frame["idx"], frame["text"], strict=True):
            if text not in kept[-look_back:]:
                kept.append(text)
                yield idx, text

    return fold(rows, [group], ["idx"], "idx long, text string", step)


#: Characters of texts whose lines a task holds at a time.
PIECE_CHARS = 1 << 20


def rollup_dropped(text: Column, look_back: int = 8) -> Column:
    """The lines of a text as an array, without those that are among the last ``look_back`` lines kept. The
    lines of a text come in one row, so nothing is shuffled; a task holds the lines of about ``PIECE_CHARS`` at a time."""

    def lines(text: str) -> list[str]:
        kept: list[str] = []
        for line in text.split("\n"):
            if line not in kept[-look_back:]:
                kept.append(line)
        return kept

    @F.arrow_udf("array<string>")
    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            done: list[list[str] | None] = []
            held = 0
            for item in texts:
                text = item.as_py()
                done.append(None if text is None else lines(text))
                held += 64 + len(text or "")
                if held >= PIECE_CHARS:
                    yield pa.array(done, pa.list_(pa.string()))
                    done, held = [], 0
            yield pa.array(done, pa.list_(pa.string()))

    return keep(text)


def fold_turns(rows: DataFrame, group: str, gap: float = 18, most: int = 280) -> DataFrame:
    """Caption rows (group, idx, t0, text) as turns; see TurnFold."""
    return fold_segments(rows, [group], "idx", TurnFold(gap, most))


def fold_words(rows: DataFrame, group: str | list[str]) -> DataFrame:
    """Words (group, idx, speaker, t0, t1, word) as segments; see WordFold."""
    return fold_segments(rows, [group] if isinstance(group, str) else group, "idx", WordFold())


def budget_chunks(rows: DataFrame, group: str, size: str, budget: int, overlap: int) -> DataFrame:
    """Ranges (start, end) of rows whose sizes stay within the budget; each but the first starts
    ``overlap`` rows before the end of the one before."""

    def step(frame: pd.DataFrame) -> Iterable[tuple]:
        sizes = frame[size].tolist()
        start = 0
        while start < len(sizes):
            end, total = start, 0
            while end < len(sizes) and (end == start or total + sizes[end] <= budget):
                total += sizes[end]
                end += 1
            yield start, end
            if end == len(sizes):
                break
            start = max(start + 1, end - overlap)

    return fold(rows, [group], ["idx"], "start long, end long", step)
