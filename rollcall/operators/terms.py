"""Term lists, corrections, choices between candidates, and addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rollcall.functions.text import clean_text, name_variants


def keyword_terms(bodies: DataFrame, lists: DataFrame, common: list[str]) -> DataFrame:
    """``bodies`` (body) with the terms of every list (keywords array, terms array) that has a keyword
    contained in the body's name, then the common ones; each term once, letter case aside.

    Bodies are made distinct, cut into their substrings of at most the longest keyword's length, and joined to
    the keywords by equality.
    """
    names = bodies.select("body").distinct()
    keys = lists.withColumn("ord", F.monotonically_increasing_id()).select("ord", "terms", F.explode("keywords").alias("k")).withColumn("k", F.lower("k"))
    longest = keys.agg(F.max(F.length("k"))).first()[0] or 0
    low, size = F.lower("body"), F.length("body")
    starts = lambda width: F.transform(F.sequence(F.lit(1), F.greatest(size - width + 1, F.lit(1))), lambda at: F.substr(low, at, width))
    pieces = F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.greatest(size, F.lit(1)), F.lit(max(longest, 1)))), starts))))
    hits = names.select("body", F.explode(pieces).alias("k")).join(keys, "k").select("body", "ord", "terms").distinct()
    found = names.join(hits, "body", "left")
    per = found.groupBy("body").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.col("terms").isNotNull(), F.struct("ord", "terms")))), lambda x: x["terms"])).alias("own"))
    every = F.concat("own", F.lit(common).cast("array<string>"))
    once = F.filter(F.transform(every, lambda t, i: F.struct(clean_text(t).alias("t"), F.array_position(F.transform(every, lambda u: F.lower(clean_text(u))), F.lower(clean_text(t))).alias("first"), (i + 1).alias("at"))), lambda x: (x["first"] == x["at"]) & (x["t"] != ""))
    return per.select("body", F.transform(once, lambda x: x["t"]).alias("terms"))


def expand_names(names: DataFrame, limit: int | None = None) -> DataFrame:
    """One row (name, variant, ord) for each spelling of each name."""
    out = names.select("name", F.posexplode(name_variants(F.col("name"))).alias("ord", "variant"))
    return out if limit is None else out.filter(F.col("ord") < limit)


def apply_corrections(rows: DataFrame, corrections: DataFrame) -> DataFrame:
    """``rows`` (id, speaker) with the speaker that a high-confidence correction (id, speaker, corrected,
    confidence) gives, found by id, else by speaker; of several the last ``ord``."""
    sure = corrections.filter("confidence = 'high'")
    last = lambda k: sure.filter(F.col(k).isNotNull()).groupBy(k).agg(F.max_by("corrected", "ord").alias(f"by_{k}"))
    out = rows.join(last("id"), "id", "left").join(last("speaker"), "speaker", "left")
    return out.withColumn("speaker", F.coalesce("by_id", "by_speaker", "speaker")).select(*rows.columns)


def batch_results(output: DataFrame, parts: DataFrame) -> DataFrame:
    """Parts (custom_id, ...) with the body of their answered row; unknown ids and errors are passed over."""
    good = output.filter(F.col("response.status_code") == 200).select("custom_id", "response.body")
    return parts.join(good, "custom_id")


def better_candidate(candidates: DataFrame, key: str, distance: str, attempt: str) -> DataFrame:
    """For each key the candidate of least distance; a retry wins ties."""
    n = F.row_number().over(W.partitionBy(key).orderBy(distance, F.col(attempt).desc()))
    return candidates.withColumn("_n", n).filter("_n = 1").drop("_n")


def part_counts(segments: DataFrame) -> DataFrame:
    """segments, number of labels and their sorted list for each part."""
    return segments.groupBy("meeting_key", "part").agg(F.count("*").alias("segments"), F.count_distinct("label").alias("speakers"), F.array_sort(F.collect_set("label")).alias("labels"))


def ordered_text(rows: DataFrame, group: list[str], order: str, text: str, separator: str = " ") -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct(order, text)))
    return rows.groupBy(*group).agg(F.array_join(F.transform(parts, lambda x: x[text]), separator).alias("text"))


def first_seen(values: Column) -> Column:
    """A single value as such, several as a JSON list, in the order given."""
    once = F.array_distinct(F.array_compact(values))
    return F.when(F.size(once) == 1, F.get(once, F.lit(0))).otherwise(F.to_json(once))


def address(template: str, **parts: Column) -> Column:
    """A URL from a template with {names}; null if any part is missing."""
    out, rest = [], template
    while "{" in rest:
        head, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(head), parts[name].cast("string")]
    return F.concat(*out, F.lit(rest))


def prompt(rows: DataFrame, group: list[str], order: str, line: Column, template: str) -> DataFrame:
    """A request for each group: the template with {lines}, the group's lines in order, and {names} of the group's
    columns. Its size is the group's; larger groups are cut with ``sequence.budget_chunks`` first."""
    lined = ordered_text(rows.withColumn("_line", line), group, order, "_line", "\n")
    return lined.withColumn("prompt", address(template, lines=F.col("text"), **{g: F.col(g) for g in group})).drop("text")


def retained_terms(terms: DataFrame, key: Column, limit: int | None = None) -> DataFrame:
    """``terms`` (term, source, ord) of which each key stays once, where it comes first, and ``limit`` of them in
    all. A limited list is short by its purpose, so ranking it is one task's work over distinct terms."""
    once = terms.withColumn("_key", key).filter("_key <> ''").groupBy("_key").agg(F.min_by(F.struct("term", "source", "ord"), "ord").alias("t")).select("t.*")
    return once if limit is None else once.orderBy("ord").limit(limit)


def source_counts(retained: DataFrame) -> DataFrame:
    """How many of the terms that stayed each source gave."""
    return retained.groupBy("source").agg(F.count("*").alias("n"))
