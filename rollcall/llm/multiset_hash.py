"""Order-independent fingerprints of documents: homomorphic multiset hashes of their paragraphs.

A paragraph is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors,
each lane modulo a power of two. So the order of paragraphs does not matter, and a paragraph is put in
or taken out by adding or subtracting its vector, without the other paragraphs.

A vector has three groups of lanes. ``sums``: the eight 32-bit words of the paragraph's SHA-256, modulo
2^32: equal for equal multisets of paragraphs and otherwise not. ``marks``: for each of 64 bits, how many of the
paragraph's pieces (three words in a row) have it set in their own hash, modulo 2^31. ``pieces``: their
number. With +1 for a set bit and -1 for a clear one the marks are random projections of the multiset of pieces, so
the difference of two fingerprints estimates how much the documents differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Two lanes of marks lie in one long, so that one sum counts both.
LOW, BOTH = 0xFFFFFFFF, 0x0000000100000001
#: Documents that are brought into order together, and the most such groups.
GROUP_ROWS, MOST_GROUPS = 4000, 16384


def _elements(paragraph: Column, words: Column) -> Column:
    """The paragraph itself, then its pieces: each three words in a row, or all words if there are fewer."""
    size = F.size(words)
    shifted = [F.slice(words, k, size) for k in (2, 3)]
    triples = F.arrays_zip(words.alias("a"), shifted[0].alias("b"), shifted[1].alias("c"))
    pieces = F.slice(triples, F.lit(1), F.greatest(size - 2, F.lit(1)))
    whole = F.struct(paragraph.alias("a"), F.lit(None).cast("string").alias("b"), F.lit(None).cast("string").alias("c"))
    return F.concat(F.array(whole), pieces)


def _word(h: Column, k: int) -> Column:
    """The k-th 64 bits of a hash in hexadecimal, as a long."""
    return F.conv(F.substring(h, 16 * k + 1, 16), 16, -10).cast("long")


_SUMS, _MARKS = [f"s{k}" for k in range(8)], [f"m{k}" for k in range(32)]


def lanes(rows: DataFrame, key: list[str], paragraphs: str) -> DataFrame:
    """``key`` and the lanes of each key's paragraphs (an array of strings in column ``paragraphs``)."""
    each = rows.select(*key, F.explode(paragraphs).alias("p"))
    # words are a column of their own, so that a paragraph is split once
    each = each.withColumn("w", F.array_remove(F.split("p", r"[\x20\x09-\x0D]+"), ""))
    each = each.select(*key, F.posexplode(_elements(F.col("p"), F.col("w"))).alias("k", "e"))
    each = each.select(*key, (F.col("k") == 0).alias("whole"), F.sha2(F.concat_ws(" ", "e.a", "e.b", "e.c"), 256).alias("h"))
    # no column is null: of a paragraph's own row the word for marks is 0, of the others those for sums are
    word = lambda k, chosen: F.when(chosen, F.coalesce(_word(F.col("h"), k), F.lit(0))).otherwise(F.lit(0))
    each = each.select(*key, "whole", word(0, ~F.col("whole")).alias("bits"), *[word(k, F.col("whole")).alias(f"w{k}") for k in range(4)])
    halves = [x for k in range(4) for x in (F.shiftrightunsigned(f"w{k}", 32), F.col(f"w{k}").bitwiseAND(LOW))]
    # a bit of the upper half lies beside the bit of the lower half at the same place
    bits = [F.shiftrightunsigned("bits", 31 - i).bitwiseAND(BOTH) for i in range(32)]
    sums = [F.sum(x).alias(c) for c, x in zip([*_SUMS, *_MARKS], [*halves, *bits], strict=True)]
    return each.groupBy(*key).agg(*sums, F.count_if(~F.col("whole")).alias("pieces"))


def _fingerprint(lane) -> Column:
    """The fingerprint, a struct, from a function that gives the sum of a lane's column."""
    packed = F.array(*[lane(c) for c in _MARKS])
    marks = F.concat(F.transform(packed, lambda v: F.shiftright(v, 32)), F.transform(packed, lambda v: v.bitwiseAND(LOW)))
    return F.struct(F.array(*[lane(c).bitwiseAND(LOW) for c in _SUMS]).alias("sums"), lane("pieces").alias("pieces"), marks.alias("marks"))


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and fingerprint (a struct) of the text of each key; rows of one key are summed up."""
    text = F.coalesce(F.col("text"), F.lit(""))
    summed = lanes(docs.select(key, F.split(text, "\n", -1).alias("_p")), [key], "_p")
    return summed.select(key, _fingerprint(lambda c: F.coalesce(F.col(c), F.lit(0))).alias("fingerprint"))


def _zipped(a: Column, b: Column, sign: int) -> Column:
    add = lambda x, y: x + sign * y
    sums = F.zip_with(a["sums"], b["sums"], lambda x, y: add(x, y).bitwiseAND(LOW))
    return F.struct(sums.alias("sums"), add(a["pieces"], b["pieces"]).alias("pieces"), F.zip_with(a["marks"], b["marks"], add).alias("marks"))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both: insertion."""
    return _zipped(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``, which it has: deletion."""
    return _zipped(a, b, -1)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else an estimate of 1 - |a - b|^2 / (|a|^2 + |b|^2) for the vectors of
    how often each piece occurs (Dice's coefficient where pieces occur once), cut off at 0. Its standard error is
    at most 0.13. Where neither has a word, texts that differ have no likeness."""
    signs = lambda x: F.transform(x["marks"], lambda m: (2 * m - x["pieces"]).cast("double"))
    square = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)
    u, v = signs(a), signs(b)
    apart = square(F.zip_with(u, v, lambda x, y: x - y))
    norms = square(u) + square(v)
    return F.when(a["sums"] == b["sums"], 1.0).when(norms == 0, 0.0).otherwise(F.greatest(1 - apart / norms, F.lit(0.0)))


def to_text(x: Column) -> Column:
    """The fingerprint as a string: sums, number of pieces, marks."""
    return F.concat_ws(";", F.array_join(x["sums"].cast("array<string>"), ","), x["pieces"].cast("string"), F.array_join(x["marks"].cast("array<string>"), ","))


def _longs(values: list) -> Column:
    """A constant array; -1 stands for None where a bucket is empty, and is never asked for."""
    return F.slice(F.split(F.lit(",".join(["0", *(str(-1 if v is None else int(v)) for v in values)])), ",").cast("array<bigint>"), 2, max(1, len(values)))


def _grouped(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with bucket: stretches of about GROUP_ROWS rows in the order of doc_id.

    In each bucket there is also, with extra, the first document of the next one (behind the last: of the first,
    with wrap), so that a bucket knows the successor of each of its documents. What the driver sees are two
    numbers for each bucket. Rows without doc_id are dealt by their text.
    """
    spark = docs.sparkSession
    n = docs.filter("doc_id is not null").count()
    many = min(MOST_GROUPS, max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // GROUP_ROWS))
    edges = docs.agg(F.percentile_approx("doc_id", [k / many for k in range(1, many)], 10 * many)).first()[0] if n else []
    edges = _longs(sorted(set(edges or [])))
    # binary search: how many edges are not above the id
    halving = F.array(*[F.lit(1 << k) for k in reversed(range(many.bit_length()))])
    within = F.aggregate(halving, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) <= F.col("doc_id"), at + step).otherwise(at))
    nowhere = -1 - F.pmod(F.xxhash64("text"), F.lit(many)).cast("int")
    placed = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), nowhere).otherwise(within))
    starts = sorted((r["bucket"], r["low"]) for r in placed.filter("doc_id is not null").groupBy("bucket").agg(F.min("doc_id").alias("low")).collect())
    if not starts:
        return placed.withColumns({"wrap": F.lit(0), "extra": F.lit(False)})
    lows, before = [None] * (starts[-1][0] + 1), [0] * (starts[-1][0] + 1)
    for (b, low), (prior, _) in zip(starts, [starts[-1], *starts[:-1]], strict=True):
        lows[b], before[b] = low, prior
    at = lambda values: F.get(_longs(values), F.col("bucket"))
    place = lambda b, wrap, extra: F.struct(b.cast("int").alias("bucket"), wrap.alias("wrap"), F.lit(extra).alias("extra"))
    own = place(F.col("bucket"), F.lit(0), False)
    again = place(at(before), (F.col("bucket") == starts[0][0]).cast("int"), True)
    first = F.coalesce(at(lows) == F.col("doc_id"), F.lit(False))
    both = placed.withColumn("_at", F.explode(F.when(first, F.array(own, again)).otherwise(F.array(own))))
    return both.select(*docs.columns, "_at.*")


def compare_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every
    row of ``docs`` (doc_id, an integer, and text).

    The edited text has its last quarter of code points replaced by the first as many (or all) of the next
    document, ascending doc_id; behind the last comes the first. Only what lies behind the last paragraph that both share
    whole is hashed twice. A null text is empty; an empty one is one empty paragraph. Of rows with one doc_id the
    least text is what precedes, and all have the same successor; repeated rows each have a result. Without
    doc_id there is no successor: the columns that need one are null. A text must fit in a row; its pieces are streamed. Other columns are ignored; an
    empty table gives an empty result.
    """
    rows = _grouped(docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    down = W.partitionBy("bucket").orderBy(F.desc("wrap"), F.desc("doc_id"), F.desc("text"))
    order = F.struct("wrap", "doc_id")
    # in descending order the row ahead of the first of an id is the next document; the id's others take it from the first
    rows = rows.withColumn("rn", F.row_number().over(down)).withColumn("_ahead", F.when(~F.lag(order).over(down).eqNullSafe(order), F.lag("text").over(down)))
    rows = rows.withColumn("_next", F.last("_ahead", ignorenulls=True).over(down.rowsBetween(W.unboundedPreceding, 0)))
    n = F.length("text")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("_cut", (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    rows = rows.withColumn("_kept", F.substring("text", F.lit(1), F.col("_cut")))
    rows = rows.withColumn("_edited", F.concat("_kept", F.substring("_next", F.lit(1), F.col("n_chars").cast("int") - F.col("_cut"))))
    # code points up to the last line break within what stays, with it
    shared = F.col("_cut") - F.length(F.substring_index("_kept", "\n", -1))
    split = lambda c: F.split(c, "\n", -1)
    tail = lambda c: split(F.substring(F.col(c), F.col("_shared") + 1, F.length(c)))
    part = lambda k, c: F.struct(F.lit(k).alias("part"), c.alias("paragraphs"))
    head = F.when(F.col("_shared") > 0, split(F.substring("text", F.lit(1), F.col("_shared") - 1)))
    parts = F.array(part(0, head), part(1, tail("text")), part(2, tail("_edited")))
    key = ["bucket", "rn", "wrap", "doc_id", "extra", "n_chars", "edited_sha256"]
    rows = rows.withColumn("_shared", shared).withColumn("edited_sha256", F.sha2("_edited", 256)).withColumn("_part", F.explode(parts))
    summed = lanes(rows.select(*key, "_part.*"), [*key, "part"], "paragraphs")
    of = lambda gone: lambda c: F.col(f"{c}_{gone}")
    columns = [*_SUMS, *_MARKS, "pieces"]
    summed = summed.groupBy(*key).agg(*[F.coalesce(F.sum(F.when(F.col("part") != gone, F.col(c))), F.lit(0)).alias(f"{c}_{gone}") for gone in (1, 2) for c in columns])
    both = summed.select(*key, _fingerprint(of(2)).alias("own"), _fingerprint(of(1)).alias("changed"))
    again = W.partitionBy("bucket").orderBy("rn")
    both = both.withColumn("_ahead", F.when(~F.lag(order).over(again).eqNullSafe(order), F.lag("own").over(again)))
    both = both.withColumn("_next", F.last("_ahead", ignorenulls=True).over(again.rowsBetween(W.unboundedPreceding, 0)))
    known = F.col("doc_id").isNotNull()
    own, changed, following = F.col("own"), F.col("changed"), F.col("_next")
    return both.filter("not extra").select(
        "doc_id", "n_chars", "edited_sha256",
        to_text(own).alias("fingerprint"), F.when(known, to_text(changed)).alias("edited_fingerprint"),
        F.when(known, likeness(own, changed)).alias("near_edited"), F.when(known, likeness(own, following)).alias("near_next"),
    )
