"""Sharding by a k-d tree over document metadata, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rollcall.llm.common import stash

#: A coordinate is 2**62 wide; one pass narrows it by BINS.
SPAN, BINS = 1 << 62, 1 << 11


@dataclass(frozen=True)
class Node:
    """A box of the tree that shall become ``leaves`` shards, the first of which is ``first``."""

    first: int
    leaves: int


def _coordinate(value: Column, low: float, high: float) -> Column:
    """The value's place in [low, high] as 31 high bits, the group's hash as 31 low bits: ties of a
    metadata value can be split, and any two groups have different coordinates."""
    place = F.lit(0) if high <= low else F.floor((value - low) / (high - low) * ((1 << 31) - 1))
    return F.shiftleft(place.cast("long"), 31) + F.pmod(F.col("h2"), F.lit(1 << 31))


def kd_shards(rows: DataFrame, group: list[str], size: str, dims: list[str], n: int, tolerance: float = 0.001) -> DataFrame:
    """``group`` columns and shard (0 to n - 1) of every distinct group of ``rows``.

    A node is split in two along the metadata dimension that is widest in it (standard deviation over
    the table's range, weighted by size) at the weighted quantile that gives both sides bytes in
    proportion to their leaves; with all nodes of a level in the same passes, so the driver sees at
    most n * BINS counts at once. Quantiles are found by narrowing bins until the bin that holds
    one weighs under ``tolerance`` of a leaf, or holds one group. A group (equal texts) is one point
    and stays together, so a group larger than a leaf makes its shard larger. Copies are summed before
    anything is shuffled. Null metadata counts as 0. An empty table gives an empty result.
    """
    merged = rows.groupBy(*group).agg(F.sum(size).alias("w"), *[F.min(F.coalesce(F.col(d).cast("double"), F.lit(0.0))).alias(d) for d in dims])
    points = stash(merged.withColumn("h2", F.xxhash64(*group, F.lit(77))))
    bounds = points.agg(F.sum("w").alias("w"), *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("lo", F.min), ("hi", F.max))]).first()
    if not bounds["w"]:
        return points.select(*group, F.lit(0).alias("shard"))
    leaf = bounds["w"] / n
    coords = {d: _coordinate(F.col(d), bounds[f"lo_{d}"], bounds[f"hi_{d}"]) for d in dims}
    points = points.select(*group, "w", *[c.alias(d) for d, c in coords.items()])
    nodes, where = [Node(0, n)], F.lit(0)  # where: the first leaf of the node that a point is in
    while any(x.leaves > 1 for x in nodes):
        todo = [x for x in nodes if x.leaves > 1]
        # dimensions are compared on the same scale: sqrt of the weighted variance of the coordinate
        stat = [F.sum(F.col("w").cast("double")).alias("w")]
        for d in dims:
            at = F.col(d) / SPAN
            stat += [F.sum(F.col("w") * at).alias(f"m_{d}"), F.sum(F.col("w") * at * at).alias(f"s_{d}")]
        spread = {r["node"]: r for r in points.groupBy(where.alias("node")).agg(*stat).collect()}
        axis, goal = {}, {}
        for x in todo:
            r = spread.get(x.first)
            if r is None or not r["w"]:
                axis[x.first], goal[x.first] = dims[0], 0
                continue
            axis[x.first] = max(dims, key=lambda d: (r[f"s_{d}"] / r["w"] - (r[f"m_{d}"] / r["w"]) ** 2, -dims.index(d)))
            goal[x.first] = r["w"] * (x.leaves // 2) / x.leaves
        cuts = _weighted_quantiles(points, where, axis, goal, tolerance * leaf)
        side, below = where, []
        for x in nodes:
            if x.leaves == 1:
                below.append(x)
                continue
            left = x.leaves // 2
            right = Node(x.first + left, x.leaves - left)
            side = F.when((where == x.first) & (F.col(axis[x.first]) >= cuts[x.first]), F.lit(right.first)).otherwise(side)
            below += [Node(x.first, left), right]
        points = points.withColumn("node", side)
        where, nodes = F.col("node"), below
        points = stash(points)
    return points.select(*group, where.cast("int").alias("shard"))


def _weighted_quantiles(points: DataFrame, where: Column, axis: dict[int, str], goal: dict[int, float], enough: float) -> dict[int, int]:
    """For each node the coordinate below which its weight comes nearest to the goal."""
    lo, hi = dict.fromkeys(axis, 0), dict.fromkeys(axis, SPAN)
    before = dict.fromkeys(axis, 0.0)
    cut = {}
    while len(cut) < len(axis):
        open_ = [k for k in axis if k not in cut]
        chosen = None
        for k in open_:
            width = max(1, (hi[k] - lo[k]) // BINS)
            inside = (where == k) & (F.col(axis[k]) >= lo[k]) & (F.col(axis[k]) < hi[k])
            bin_ = F.struct(F.lit(k).alias("node"), ((F.col(axis[k]) - lo[k]) / width).cast("long").alias("bin"))
            chosen = F.when(inside, bin_) if chosen is None else chosen.when(inside, bin_)
        got = points.select(chosen.alias("k"), "w").filter("k is not null").groupBy("k").agg(F.sum("w").alias("w"), F.count("*").alias("n")).collect()
        for k in open_:
            width, total = max(1, (hi[k] - lo[k]) // BINS), before[k]
            cut[k] = hi[k]
            for r in sorted((r for r in got if r["k"]["node"] == k), key=lambda r: r["k"]["bin"]):
                start = lo[k] + r["k"]["bin"] * width
                if total + r["w"] >= goal[k]:
                    if r["w"] > enough and r["n"] > 1 and width > 1:
                        del cut[k]
                        lo[k], hi[k], before[k] = start, start + width, total
                    else:  # the bin goes to the side that it leaves nearer to the goal
                        cut[k] = start + width if total + r["w"] - goal[k] < goal[k] - total else start
                    break
                total += r["w"]
    return cut


def slots(rows: DataFrame, shard: str, order: list[str], per_bucket: int = 20_000) -> DataFrame:
    """``rows`` with slot: 0, 1, 2 ... without a gap in each shard.

    Rows are numbered inside hash buckets of about ``per_bucket`` rows and the buckets' counts are
    summed up to offsets, so no task orders a whole shard. ``order`` must tell rows apart for the
    numbering to be the same in each run; equal rows are interchangeable.
    """
    buckets = max(1, rows.count() // per_bucket)
    put = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    count = put.groupBy(shard, "_bucket").agg(F.count("*").alias("_n"))
    ahead = W.partitionBy(shard).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offset = count.select(shard, "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    own = put.withColumn("_i", F.row_number().over(W.partitionBy(shard, "_bucket").orderBy(*order)))
    return own.join(offset, [shard, "_bucket"]).withColumn("slot", F.col("_before") + F.col("_i") - 1).drop("_bucket", "_before", "_i")


def shard_documents(docs: DataFrame, n: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Size is the UTF-8 bytes of the text (null: none) plus 1; null and empty texts are the same group.
    Dimensions of the tree: size of the text, hash of the text, first source and language of the
    group. Law: bytes. Repeated rows stay, each with a slot of its own.
    """
    raw = F.coalesce(F.col("text"), F.lit(""))
    # literals stand in front: behind the text a hash would follow from that of the text alone
    narrow = stash(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(raw) + 1).cast("long").alias("size"),
            F.crc32(raw.cast("binary")).alias("text_crc32"),
            F.xxhash64(raw).alias("g1"),
            F.xxhash64(F.lit(1), raw).alias("g2"),
            F.log(F.octet_length(raw) + 1.0).alias("d_size"),
            (F.pmod(F.xxhash64(F.lit(2), raw), F.lit(1 << 20))).alias("d_text"),
            F.pmod(F.xxhash64("source"), F.lit(1024)).alias("d_source"),
            F.pmod(F.xxhash64("lang"), F.lit(1024)).alias("d_lang"),
        )
    )
    placed = kd_shards(narrow, ["g1", "g2"], "size", ["d_size", "d_text", "d_source", "d_lang"], n)
    rows = narrow.select("doc_id", "size", "text_crc32", "g1", "g2").join(placed, ["g1", "g2"])
    numbered = slots(stash(rows), "shard", ["doc_id", "g1", "g2"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
