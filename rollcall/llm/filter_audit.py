"""What filters do to each other, whatever their order: a cube over failure flags.

Documents are reduced to counts by part and flags; a cube over these has, for every subset of the
filters, the row in which all selected flags are false: the documents that survive that subset. A step
of an order leads from one subset to a subset with one filter more, so all orders follow from joins of
such pairs.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rollcall.llm.common import stash

#: The order of n filters is written out n! times; more than this many are refused.
MOST_FILTERS = 7
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> dict[str, Column]:
    """Failures that a text shows by itself: A few words, B words repeated, C capitals, D odd signs."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, size = F.size(words), F.length(text)
    capitals = size - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": capitals.cast("long") * 100 > size.cast("long") * 5,
        "D": text.rlike(r"[#$%&*|]"),
    }


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E, good and toxic (0 or 1) for every row of ``docs`` (doc_id, text, source).

    E: the text is that of a row with a smaller doc_id. The least doc_id of each text is found by a grouped
    minimum and joined back on text and doc_id together, so copies never meet in one task. A row without
    doc_id fails nobody and does not fail E. Of repeated rows of ``labels`` any that says 1 counts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    flags = text_failures(text)
    rows = stash(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("h"), *[c.alias(k) for k, c in flags.items()]))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    said = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.max(F.coalesce((F.col(a) == 1).cast("int"), F.lit(0))).alias(b) for a, b in (("quality", "good"), ("toxic", "toxic"))])
    out = rows.join(first, ["h", "doc_id"], "left").join(said, "doc_id", "left")
    later = F.col("_first").isNull() & F.col("doc_id").isNotNull()
    return out.select("part", *flags, later.alias("E"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def audit(rows: DataFrame, filters: str, weights: tuple[str, ...] = ("good", "toxic")) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, a ``_lost`` column for each weight,
    shapley; for every part of ``rows`` (part, a boolean column for each letter of ``filters``, weights),
    each order of the filters and each step of it.

    Rows are counted by part and flags before anything else is done, so a part of any size is at most
    2^n rows. A null flag counts as not failing, a null weight as 0, a null part is a part. An empty
    table gives an empty result; repeated rows count each.
    """
    names = list(filters)
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters: {filters}")
    bit = {f: 1 << i for i, f in enumerate(names)}
    whole = (1 << len(names)) - 1
    sums = ["n", *weights]
    counted = rows.groupBy("part", *[F.coalesce(f, F.lit(False)).alias(f) for f in names]).agg(F.count("*").alias("n"), *[F.sum(F.coalesce(w, F.lit(0))).cast("long").alias(w) for w in weights])
    counted = stash(counted.withColumns({"n": F.col("n").cast("long"), "_part": F.coalesce("part", F.lit("")), "_null": F.col("part").isNull()}))
    cube = counted.cube("_part", "_null", *names).agg(*[F.sum(c).alias(c) for c in sums], *[F.grouping(c).alias(f"_{c}") for c in ("_part", "_null", *names)])
    selected = reduce(lambda a, b: a + b, [(1 - F.col(f"_{f}").cast("int")) * bit[f] for f in names])
    clean = reduce(lambda a, b: a & b, [F.coalesce(~F.col(f), F.lit(True)) for f in names])
    alive = cube.filter((F.col("__part") == 0) & (F.col("__null") == 0) & clean).select("_part", "_null", selected.alias("subset"), *sums)
    # a subset that nothing survives has no row in the cube
    grid = counted.select("_part", "_null").distinct().withColumn("subset", F.explode(F.sequence(F.lit(0), F.lit(whole))))
    part = ["_part", "_null"]
    alive = stash(grid.join(alive, [*part, "subset"], "left").na.fill(0, sums))
    # pairs of subsets, of which the second has one filter more
    before = alive.withColumn("f", F.explode(F.array(*[F.struct(F.lit(f).alias("name"), F.lit(b).alias("bit")) for f, b in bit.items()]))).filter("subset & f.bit = 0")
    after = alive.select(*part, F.col("subset").alias("_then"), *[F.col(c).alias(f"_{c}") for c in sums])
    pairs = before.withColumn("_then", F.expr("subset | f.bit")).join(after, [*part, "_then"])
    pairs = pairs.select(*part, "subset", F.col("f.name").alias("f"), F.col("_n").alias("kept"), (F.col("n") - F.col("_n")).alias("removed"), *[(F.col(w) - F.col(f"_{w}")).alias(f"{w}_lost") for w in weights])
    pairs = stash(pairs)
    alone = pairs.filter("subset = 0").select(*part, "f", F.col("removed").alias("_fails"))
    rest = F.element_at(F.create_map(*[F.lit(x) for f, b in bit.items() for x in (f, whole ^ b)]), F.col("f"))
    unique = pairs.filter(F.col("subset") == rest).select(*part, "f", F.col("removed").alias("unique_fails"))
    steps = [("".join(o), k + 1, o[k], sum(bit[x] for x in o[:k])) for o in permutations(names) for k in range(len(names))]
    steps = F.broadcast(rows.sparkSession.createDataFrame(steps, "filter_order string, step int, f string, subset int"))
    out = pairs.join(steps, ["f", "subset"]).join(alone, [*part, "f"]).join(unique, [*part, "f"])
    every = W.partitionBy(*part, "f")
    return out.select(
        F.when(~F.col("_null"), F.col("_part")).alias("part"),
        "filter_order", "step", "kept", "removed", (F.col("_fails") - F.col("removed")).alias("redundant"), "unique_fails",
        *[f"{w}_lost" for w in weights], F.sum("removed").over(every).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs`` (doc_id, text, source) with ``labels`` (doc_id, quality, toxic).

    Null texts are empty, a null source is the part ''. Empty and long texts are judged as any other;
    repeated rows count each (those of the least doc_id of a text all pass E); other columns are ignored.
    """
    return audit(flagged(docs, labels), "ABCDE")
