"""Near-duplicate vectors by an inverted multi-index.

Vectors of length 1 are cut in halves, each with a codebook of its own; a pair of codes is a cell, and
all cells form a grid. For each vector a multi-sequence traversal visits cells from the nearest on, until
no cell is left that could hold a vector near enough, and the vectors in the visited cells are verified.

Links are symmetric, so a vector visits only cells behind its own in the grid. A vector is sent once to
each code of the first half that it visits, with the codes of the second half; so it has some ten copies
in the shuffle where the cells that it visits are some hundred.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.llm.common import connected_components, stash
from rollcall.llm.ngram_join import local_roots
from rollcall.llm.vectors import common_length, matrix, usable

#: Vectors of a first code that are held against others at once; a task's unit has at most five times as many.
BLOCK = 4096
#: Products of normalised vectors that come this near to the threshold are computed again from the originals.
CLOSE = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's iteration from evenly spaced samples."""
    centres = np.unique(x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)], axis=0)
    for _ in range(rounds):
        code = distances(x, centres).argmin(1)
        size = np.bincount(code, minlength=len(centres))
        sums = np.stack([np.bincount(code, column, len(centres)) for column in x.T], 1)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T, 0)


def least_squares_away(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest code, for each code a lower bound of the squared distance to any point of that code):
    a point of another code lies beyond the plane half way between the two centres."""
    d = distances(x, centres)
    own = d.argmin(1)
    apart = np.sqrt(distances(centres, centres))[own]
    beyond = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * apart, 1e-12)
    beyond[np.arange(len(x)), own] = 0
    return own, np.maximum(beyond, 0) ** 2


def traverse(first: np.ndarray, second: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The traversal of many vectors in step; rows of ``first`` and ``second`` are a vector's bounds by code.

    Both sequences are taken in order. With the nearest code of the first half a vector visits a prefix
    of the second half's sequence, with each further code a shorter one, and it ends where a prefix is empty:
    then no unvisited cell can hold a vector within ``radius``, so recall is complete. Returns (vector,
    code of the first half, number of codes in its prefix, each vector's second sequence).
    """
    sequence = np.argsort(second, 1, kind="stable")
    bounds = np.take_along_axis(second, sequence, 1)
    vector, code = np.nonzero(first + bounds[:, :1] <= radius)
    left = radius - first[vector, code]
    prefix = np.concatenate([(bounds[vector[lo : lo + 4096]] <= left[lo : lo + 4096, None]).sum(1) for lo in range(0, len(vector), 4096)])
    return vector, code, prefix, sequence


def visits(own_a: np.ndarray, own_b: np.ndarray, far_a: np.ndarray, far_b: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vector, first code, number of second codes, all second codes one after the other) of the cells
    that a vector visits: its own and, of those in reach, the ones behind it in the grid."""
    vector, code, prefix, sequence = traverse(far_a, far_b, radius)
    at = np.repeat(np.arange(len(vector)), prefix)
    second = sequence[vector[at], np.arange(len(at)) - np.repeat(np.cumsum(prefix) - prefix, prefix)]
    behind = (code[at] > own_a[vector[at]]) | ((code[at] == own_a[vector[at]]) & (second >= own_b[vector[at]]))
    count = np.bincount(at[behind], minlength=len(vector))
    some = count > 0
    return vector[some], code[some], count[some], second[behind]


def link_unit(ids: np.ndarray, x: np.ndarray, copies: np.ndarray, b: np.ndarray, member: np.ndarray, visitor: np.ndarray, native: np.ndarray, seconds: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(smallest position reached, links) of each row of a unit: visitors against members.

    Rows are in the order of their ids. ``native`` rows have the unit's first code themselves, and meet
    only members in later cells, or of their own cell with smaller ids; so a pair is met once.
    """
    z = unit(x)
    m = np.flatnonzero(member)
    m = m[np.argsort(b[m], kind="stable")]
    v = np.flatnonzero(visitor)
    codes = np.concatenate([seconds[k] for k in v]) if len(v) else np.zeros(0, np.int64)
    whose = np.repeat(v, [len(seconds[k]) for k in v])
    links, ps, qs = np.zeros(len(ids), np.int64), [], []
    for lo in range(0, len(m), 512):
        tile = m[lo : lo + 512]
        come = np.unique(whose[(codes >= b[tile[0]]) & (codes <= b[tile[-1]])])
        for at in range(0, len(come), 4096):
            rows = come[at : at + 4096]
            near = z[rows] @ z[tile].T
            p, q = np.nonzero(near >= threshold - CLOSE)
            cos = near[p, q]
            p, q = rows[p], tile[q]
            once = ~native[p] | (b[q] > b[p]) | ((b[q] == b[p]) & (q < p))
            sure = cos >= threshold + CLOSE
            for k in np.flatnonzero(once & ~sure):
                u, w = x[p[k]], x[q[k]]
                sure[k] = math.fsum(u * w) >= threshold * math.sqrt(math.fsum(u * u)) * math.sqrt(math.fsum(w * w))
            p, q = p[once & sure], q[once & sure]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            # linked pairs are folded to each row's smallest partner, so that a dense cluster stays small
            root = local_roots(len(ids), p, q)
            ps.append(np.flatnonzero(root != np.arange(len(ids))))
            qs.append(root[ps[-1]])
    return local_roots(len(ids), np.concatenate(ps), np.concatenate(qs)) if ps else np.arange(len(ids)), links


def link_vectors(vectors: DataFrame, threshold: float = 0.98, sample: int = 20_000, most_codes: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Rows of the same label are linked if the cosine of their vectors is at least ``threshold``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id reachable.
    Vectors that are null, empty, zero, or hold null or non-finite components, that differ in length from
    most, and rows without label or vec_id, link with nothing and are kept. Repeated rows are copies of each
    other. Rows of one vec_id with other vectors or labels are vectors of their own. Other columns are
    ignored; an empty table gives an empty result.

    Equal vectors of a label are one class, told apart by two independent hashes of 64 bits. The number of
    codes grows with the square root of the rows of the largest label, up to ``most_codes``; codebooks are
    fitted on at most ``sample`` classes (the first by hash), and every class is indexed. The stop of the
    traversal is a proven bound, so recall does not depend on the sample. The vectors of a first code are verified
    in blocks by their second code, to which only those visitors go that visit one of its codes; each pair of blocks is a unit of
    its own, and a task gives back one row for each vector, never pairs.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    wide = vectors.schema["embedding"].dataType.elementType.simpleString() != "float"
    marked = vectors.select("vec_id", "embedding", "label", (usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).alias("ok"))
    dim = common_length(marked.filter("ok"), "embedding")
    use = F.col("ok") & (F.size("embedding") == dim)
    # a literal in front makes the second hash start elsewhere; behind the values it would follow from the first
    keyed = marked.withColumn("h1", F.when(use, F.xxhash64("label", "embedding"))).withColumn("h2", F.when(use, F.xxhash64(F.lit(1), "label", "embedding")))
    valid = keyed.filter("h1 is not null")
    classes = stash(valid.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("embedding").alias("embedding")))
    seen = classes.orderBy("h1", "h2").limit(sample).select("embedding").toPandas()
    if not len(seen):
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    codes = min(most_codes, max(4, round(math.sqrt(largest))))
    half, known = max(1, dim // 2), unit(matrix(seen["embedding"], dim))
    books = [codebook(x, codes) for x in (known[:, :half], known[:, half:]) if x.shape[1]]
    radius = 2 * (1 - threshold) + 1e-9  # squared distance of unit vectors at the threshold
    real = np.float64 if wide else np.float32

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A class once for each first code that it visits, with the second codes to visit there."""
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x = part.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                z = unit(x.astype(np.float64))
                (own_a, far_a), (own_b, far_b) = [least_squares_away(y, c) for y, c in zip((z[:, :half], z[:, half:]), books, strict=False)] + [(np.zeros(len(z), int), np.zeros((len(z), 1)))] * (2 - len(books))
                vector, code, count, second = visits(own_a, own_b, far_a, far_b, radius)
                raw = pa.array([v.tobytes() for v in x.astype(real)], pa.binary())
                taken = [part.column(c).take(pa.array(vector)) for c in ("rep", "label", "h1", "h2", "copies")]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), pa.array(second, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*taken, raw.take(pa.array(vector)), pa.array(code, pa.int32()), pa.array(own_b[vector], pa.int32()), pa.array(own_a[vector] == code), lists],
                    ["rep", "label", "h1", "h2", "copies", "x", "code", "b", "native", "seconds"],
                )

    label = classes.schema["label"].dataType.simpleString()
    ddl = f"rep {kind}, label {label}, h1 long, h2 long, copies long, x binary, code int, b int, native boolean, seconds array<int>"
    placed = stash(classes.select("rep", "label", "h1", "h2", "copies", "embedding").mapInArrow(place, ddl))
    size = placed.groupBy("label", "code").agg(F.count_if("native").alias("m"), F.count("*").alias("n")).filter("m > 0")
    size = size.select("label", "code", F.ceil(F.col("m") / BLOCK).cast("int").alias("mb"), F.ceil(F.col("n") / (4 * BLOCK)).cast("int").alias("vb"), "n")
    # members of a first code lie in blocks by their second code, so a visitor goes only where codes are that it visits; of a second
    # code its first and last block are kept, as many rows as there are cells, and no longer list than there are codes
    cells = placed.filter("native").groupBy("label", "code", "b").agg(F.count("*").alias("c"))
    before = F.sum("c").over(W.partitionBy("label", "code").orderBy("b").rowsBetween(W.unboundedPreceding, -1))
    cells = cells.withColumn("before", F.coalesce(before, F.lit(0)))
    at = lambda x: F.floor(x / BLOCK).cast("int")
    spans = cells.groupBy("label", "code").agg(F.map_from_entries(F.collect_list(F.struct("b", F.struct(at(F.col("before")).alias("low"), at(F.col("before") + F.col("c") - 1).alias("high"))))).alias("spans"))
    # a code of one block needs no map, and no row carries one
    size = stash(size.join(spans, ["label", "code"]).withColumn("spans", F.when(F.col("mb") > 1, F.col("spans"))))
    each = placed.join(size, ["label", "code"])
    own = F.element_at("spans", F.col("b"))
    one = F.col("mb") == 1
    place_in = F.when(one, 0).otherwise(own["low"] + F.pmod("h1", own["high"] - own["low"] + 1).cast("int"))
    each = each.withColumn("own_m", F.when(F.col("native"), place_in).otherwise(0)).withColumn("own_v", F.pmod("h2", "vb").cast("int"))
    reached = F.array_compact(F.transform("seconds", lambda b: F.element_at("spans", b)))
    blocks = F.when(one, F.array(F.lit(0))).otherwise(F.array_distinct(F.flatten(F.transform(reached, lambda x: F.sequence(x["low"], x["high"])))))
    as_visitor = F.transform(blocks, lambda m: F.struct(m.alias("low"), F.col("own_v").alias("high"), (F.col("native") & (m == F.col("own_m"))).alias("member"), F.lit(True).alias("visitor")))
    as_member = F.transform(F.sequence(F.lit(0), F.col("vb") - 1), lambda v: F.struct(F.col("own_m").alias("low"), v.alias("high"), F.lit(True).alias("member"), F.lit(False).alias("visitor")))
    others = F.when(F.col("native"), F.filter(as_member, lambda u: u["high"] != F.col("own_v"))).otherwise(F.array().cast(placed.select(F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(True).alias("member"), F.lit(True).alias("visitor"))).alias("a")).schema["a"].dataType))
    units = max(1, (size.agg(F.sum("n")).first()[0] or 0) // BLOCK)
    each = each.select("*", F.explode(F.concat(as_visitor, others)).alias("u")).select(
        "rep", "h1", "h2", "copies", "x", "label", "code", "b", "native", "seconds", "u.*", F.pmod(F.xxhash64("label", "code", "u.low", "u.high"), F.lit(units)).alias("unit")
    )

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.groupby(["label", "code", "low", "high"], sort=False):
            if not part["member"].any() or len(part) < 2:
                continue
            part = part.sort_values(["rep", "h1", "h2"])
            x = np.frombuffer(b"".join(part["x"]), real).reshape(-1, dim).astype(np.float64)
            root, links = link_unit(part["rep"].to_numpy(), x, part["copies"].to_numpy(), part["b"].to_numpy(), *[part[c].to_numpy() for c in ("member", "visitor", "native")], list(part["seconds"]), threshold)
            key = part[["rep", "h1", "h2"]]
            top = key.iloc[root].add_prefix("to_").reset_index(drop=True)
            both = pd.concat([key.reset_index(drop=True), top], axis=1).assign(links=links)
            out.append(both[links > 0])
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("rep", "h1", "h2", "to_rep", "to_h1", "to_h2", "links")})

    linked = stash(each.groupBy("unit").applyInPandas(verify, f"rep {kind}, h1 long, h2 long, to_rep {kind}, to_h1 long, to_h2 long, links long"))
    node = F.struct("rep", "h1", "h2")
    to = F.struct(F.col("to_rep").alias("rep"), F.col("to_h1").alias("h1"), F.col("to_h2").alias("h2"))
    groups = connected_components(linked.select(node.alias("node"), to.alias("to")), "node", "to").select("id.h1", "id.h2", F.col("component.rep").alias("component"))
    links = linked.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    decided = classes.select("h1", "h2", "rep", "copies").join(links, ["h1", "h2"], "left").join(groups, ["h1", "h2"], "left")
    decided = stash(decided.select("h1", "h2", F.coalesce("component", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = keyed.select("vec_id", "h1", "h2").join(decided, ["h1", "h2"], "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
