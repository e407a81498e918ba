"""Matching of names that are spelt differently.

Names are made distinct first. Candidates meet on blocking keys that every admissible match shares: a
match differs in each compared word by at most two edits or has the same sound code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import name_tokens, sound_code


def token_distance(a: Column, b: Column) -> Column:
    """Edits between two words if at most 2; 2 if they sound alike; else null."""
    edits = F.levenshtein(a, b)
    alike = (F.length(a) > 2) & (F.length(b) > 2) & (sound_code(a) == sound_code(b))
    return F.when(edits <= 2, edits).when(alike, F.lit(2))


def name_score(a: Column, b: Column) -> Column:
    """Penalty between two lists of name words; null if they do not match."""
    same = (a == b) | (F.array_join(a, "") == F.array_join(b, ""))
    each = F.zip_with(a, b, token_distance)
    whole = F.when((F.size(a) == F.size(b)) & F.forall(each, lambda d: d.isNotNull()), F.aggregate(each, F.lit(0), lambda x, d: x + d))
    ends = token_distance(F.get(a, F.lit(0)), F.get(b, F.lit(0))) + token_distance(F.element_at(a, -1), F.element_at(b, -1))
    gap = F.abs(F.size(a) - F.size(b))
    score = F.when(same, F.lit(0)).otherwise(F.coalesce(whole, F.when(gap <= 2, ends + gap * 2)))
    return F.when((F.size(a) >= 2) & (F.size(b) >= 2), score)


def org_score(a: Column, b: Column) -> Column:
    same = (a == b) | (F.array_join(a, "") == F.array_join(b, ""))
    each = F.zip_with(a, b, token_distance)
    whole = F.when((F.size(a) == F.size(b)) & F.forall(each, lambda d: d.isNotNull()), F.aggregate(each, F.lit(0), lambda x, d: x + d))
    text = F.levenshtein(F.array_join(a, " "), F.array_join(b, " "))
    near = F.when((F.size(a) >= 2) & (F.size(b) >= 2) & (text <= 2), text)
    score = F.when(same, F.lit(0)).otherwise(F.coalesce(whole, near))
    return F.when((F.size(a) >= 1) & (F.size(b) >= 1) & (F.size(a) <= 10), score)


def _deletions(word: Column) -> Column:
    """The word, and what is left of it when up to two letters go: two words within two edits share one."""
    once = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substr(w, i + 1)))
    first = once(word)
    return F.array_distinct(F.concat(F.array(word), first, F.flatten(F.transform(first, once)), F.array(F.concat(F.lit("~"), sound_code(word)))))


def _whole(tokens: Column) -> Column:
    return F.array(F.concat(F.lit("="), F.array_join(tokens, "")))


def snap(names: DataFrame, anchors: DataFrame, score=name_score) -> DataFrame:
    """(name, anchor) for each distinct ``name`` with one best anchor; ties between anchors of
    different words match none, otherwise the shorter spelling wins.

    Names and anchors meet on deletion neighbourhoods of the first word, on its sound, or on all words
    run together, so no pair of a name and an anchor is formed that shares none of them.
    """
    left = names.select("name").distinct().withColumn("a", name_tokens(F.col("name"))).filter(F.size("a") > 0)
    right = anchors.select("anchor").distinct().withColumn("b", name_tokens(F.col("anchor"))).filter(F.size("b") > 0)
    key = lambda c: F.explode(F.concat(_deletions(F.get(c, F.lit(0))), _whole(c), F.filter(_deletions(F.array_join(c, " ")), lambda k: ~k.startswith("~")))).alias("key")
    pairs = left.select("name", "a", key(F.col("a"))).join(right.select("anchor", "b", key(F.col("b"))), "key").drop("key").distinct()
    scored = pairs.withColumn("score", score(F.col("a"), F.col("b"))).filter("score is not null")
    best = scored.groupBy("name").agg(F.min("score").alias("score"))
    top = scored.join(best, ["name", "score"]).groupBy("name", "score").agg(
        F.count_distinct(F.array_join("b", " ")).alias("kinds"), F.min(F.struct(F.length("anchor").alias("n"), F.col("anchor"))).alias("pick")
    )
    return top.filter("kinds = 1").select("name", F.col("pick.anchor").alias("anchor"), F.col("score").cast("int").alias("score"))
