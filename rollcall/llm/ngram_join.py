"""Similarity join of documents on the Jaccard index of their word n-grams.

Documents that share a band of MinHash values meet in a bucket. There MinHash values are compared a few at
a time; a pair is dropped once the posterior probability that it reaches the threshold is below a
tolerance, and every pair that is left is verified on its whole n-gram sets. A pair belongs to the first
band that it shares, so it is met once, and a document's text is sent only to buckets where a pair of
its own is left to verify.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import connected_components, stash
from rollcall.llm.words import gram_hashes, hash_words, mix, slices, split_words

BANDS, BAND_ROWS = 24, 5
HASHES = BANDS * BAND_ROWS
_RNG = np.random.Generator(np.random.PCG64(5))
_A = _RNG.integers(0, 2**64, HASHES, np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 2**64, HASHES, np.uint64)
#: A block has at most about so many documents and n-grams; a larger bucket is several blocks.
BLOCK_DOCS, BLOCK_GRAMS = 256, 400_000


def gram_sets(texts: pa.ChunkedArray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; of a text of 1 to n - 1 words, all its words as one."""
    flat, count = split_words(texts)
    words = hash_words(flat)
    grams = gram_hashes(words, n)
    start = np.cumsum(count) - count
    for s, c in zip(start.tolist(), count.tolist(), strict=True):
        if c >= n:
            yield np.unique(grams[s : s + c - n + 1])
        else:
            yield gram_hashes(words[s : s + c], c) if c else np.zeros(0, np.uint64)


def minhash(grams: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 2**32 - 1, np.uint64)
    for k in range(0, len(grams), 2048):
        part = (grams[k : k + 2048, None] * _A + _B) >> np.uint64(32)
        np.minimum(out, part.min(0), out=out)
    return out.astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    rows = signature.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float, step: int = 12) -> list[tuple[int, int]]:
    """(hashes compared, least number of equal ones) for a pair to stay.

    With a uniform prior, the Jaccard index after m equal values of n has a Beta(m + 1, n - m + 1)
    posterior; it is at least t with the probability that a Binomial(n + 1, t) is at most m.
    """
    out = []
    for n in range(step, HASHES + 1, step):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def surviving_pairs(sig_a: np.ndarray, sig_b: np.ndarray, p: np.ndarray, q: np.ndarray, plan: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (p, q) that incremental comparison leaves."""
    same, done = np.zeros(len(p), np.int32), 0
    for n, least in plan:
        same = same + (sig_a[p, done:n] == sig_b[q, done:n]).sum(1, dtype=np.int32)
        keep = same >= least
        p, q, same, done = p[keep], q[keep], same[keep], n
        if not len(p):
            break
    return p, q


def common_grams(sets: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact size of the intersection for each pair of positions in ``sets``."""
    if len(p) < 2 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(p, q, strict=True)], np.int64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    doc, column = doc[times[column] > 1], column[times[column] > 1]
    rank = np.cumsum(times > 1) - 1
    column, both = rank[column], np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, 8192):
        here = (column >= lo) & (column < lo + 8192)
        has = np.zeros((len(sets), 8192), np.float32)
        has[doc[here], column[here] - lo] = 1
        both += has @ has.T
    return both[p, q].astype(np.int64)


def local_roots(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest position that each of ``n`` positions reaches by the pairs."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, p, root[q])
        np.minimum.at(new, q, root[p])
        new = new[new]
        if (new == root).all():
            return root
        root = new


#: Pairs of signatures compared at once.
PAIRS = 200_000


def block_pairs(sigs: np.ndarray, start: np.ndarray, side: np.ndarray, within: np.ndarray, band: np.ndarray, plan: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs that comparison leaves, PAIRS or so at a time. Rows lie in groups, one for each pair of blocks
    of a bucket, that begin at ``start``; pairs are inside a group, of rows of different ``side`` unless it
    is one block ``within`` itself. Pairs that share a band before the row's belong to that band's bucket."""
    end = np.repeat(np.r_[start[1:], len(sigs)], np.diff(np.r_[start, len(sigs)]))
    after = end - np.arange(len(sigs)) - 1  # rows of the group behind each row
    total, lo = np.cumsum(after), 0
    while lo < len(sigs):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, "right")))
        p = np.repeat(np.arange(lo, hi), after[lo:hi])
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(after[lo:hi]) - after[lo:hi], after[lo:hi])
        cross = within[p] | (side[p] != side[q])
        p, q = p[cross], q[cross]
        # near copies share most bands: the first one sorts out most of the pairs that belong elsewhere, before they are compared
        top = int(band[p].max(initial=0))
        for k in range(top):
            if k == 1:
                p, q = surviving_pairs(sigs, sigs, p, q, plan)
            own = slice(k * BAND_ROWS, (k + 1) * BAND_ROWS)
            other = (band[p] <= k) | (sigs[p, own] != sigs[q, own]).any(1)
            p, q = p[other], q[other]
        if top < 2:
            p, q = surviving_pairs(sigs, sigs, p, q, plan)
        yield p, q
        lo = hi


def link_block(pairs: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], copies: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(smallest position reached, links) of each document of a unit; a linked text counts with all its copies."""
    size, links = np.array([len(s) for s in sets]), np.zeros(len(sets), np.int64)
    ps, qs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q, start in pairs:
        # pairs come in the order of their groups, and a group's texts are counted together
        cuts = np.flatnonzero(np.diff(np.searchsorted(start, p, "right"), prepend=-1))
        both = np.zeros(len(p), np.int64)
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(p)], strict=True):
            base, top = int(p[lo]), int(q[lo:hi].max()) + 1
            both[lo:hi] = common_grams(sets[base:top], p[lo:hi] - base, q[lo:hi] - base)
        linked = both / np.maximum(size[p] + size[q] - both, 1) >= threshold
        p, q = p[linked], q[linked]
        links += np.bincount(p, copies[q], len(sets)).astype(np.int64) + np.bincount(q, copies[p], len(sets)).astype(np.int64)
        root = local_roots(len(sets), p, q)
        ps.append(np.flatnonzero(root != np.arange(len(sets))))
        qs.append(root[ps[-1]])
    return local_roots(len(sets), np.concatenate(ps), np.concatenate(qs)), links


def _stack(signatures: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, HASHES)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, h (hash of the text), c1, c2 (of the n-gram set), n_grams, signature, bands of each row, by scanning only.

    c1, c2 and bands are null for rows without a word or without doc_id; they link with nothing."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            ids = piece.column("doc_id").combine_chunks()
            c1, c2, size, sig, bands = [], [], [], [], []
            for known, grams in zip(ids.is_valid().to_pylist(), gram_sets(piece.column("text"), n), strict=True):
                if not known or not len(grams):
                    for column in (c1, c2, sig, bands):
                        column.append(None)
                    size.append(0)
                    continue
                c1.append(int(mix(grams).sum().view(np.int64)))
                c2.append(int(mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)))
                own = minhash(grams)
                size.append(len(grams))
                sig.append(own.tobytes())
                bands.append(band_keys(own))
            yield pa.RecordBatch.from_arrays(
                [ids, piece.column("h").combine_chunks(), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(size, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "h", "c1", "c2", "n_grams", "signature", "bands"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(scan, f"doc_id {kind}, h long, c1 long, c2 long, n_grams long, signature binary, bands array<long>")


def decide(docs: DataFrame, n: int = 5, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """What ``jaccard_join`` gives, with ``h`` (hash of the row's own text), c1 and c2 (of its n-gram set, null
    without words or doc_id), so that rows of one doc_id with different texts can be told apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    plan = least_matches(threshold, tolerance)
    seen = stash(signatures(docs, n))
    classes = stash(seen.filter("c1 is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("n_grams").alias("n_grams")))

    # one row of each class goes on; equal rows of its smallest doc_id are interchangeable
    chosen = seen.join(classes.select("c1", "c2", F.col("rep").alias("doc_id"), "copies"), ["c1", "c2", "doc_id"]).dropDuplicates(["c1", "c2"])
    reps = stash(chosen.select("c1", "c2", "doc_id", "h", "copies", "n_grams", "signature", "bands"))
    rows = reps.select("c1", "c2", "n_grams", F.posexplode("bands").alias("band", "bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_grams").alias("grams")).filter("n > 1")
    sizes = stash(sizes.select("bucket", "n", F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int").alias("blocks")))
    met = rows.join(sizes, "bucket").withColumn("block", F.pmod("c2", "blocks").cast("int"))
    work = max(1, (sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0) // 2000)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = met.select("c1", "c2", "band", "bucket", "block", other).join(reps.select("c1", "c2", "doc_id", "signature"), ["c1", "c2"])
    met = met.select("c1", "c2", "doc_id", "signature", "band", "bucket", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    met = met.withColumn("unit", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(work)))

    def ordered(frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
        """The rows by group and id, where groups begin, and the pairs that are left."""
        frame = frame.sort_values(["bucket", "low", "high", "doc_id", "c1", "c2"]).reset_index(drop=True)
        key = frame[["bucket", "low", "high"]].to_numpy()
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        low, high, block, band = (frame[c].to_numpy() for c in ("low", "high", "block", "band"))
        return frame, start, block_pairs(_stack(frame["signature"]), start, block == high, low == high, band, plan)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        """The documents of each block pair that have a pair left."""
        own, _, pairs = ordered(frame)
        left = np.zeros(len(own), bool)
        for p, q in pairs:
            left[p] = left[q] = True
        return own.loc[left, ["c1", "c2", "band", "bucket", "block", "low", "high"]]

    place = "c1 long, c2 long, band int, bucket long, block int, low int, high int"
    left = stash(met.groupBy("unit").applyInPandas(compare, place))

    work = max(1, left.count() // 300)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).filter("doc_id is not null")
    wanted = left.join(reps.drop("bands", "n_grams"), ["c1", "c2"])
    full = wanted.join(texts, ["doc_id", "h"]).withColumn("unit", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(work)))

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        own, start, pairs = ordered(frame.drop_duplicates(["bucket", "low", "high", "c1", "c2"]))
        sets = list(gram_sets(pa.chunked_array([pa.array(own["text"], pa.string())]), n))
        root, links = link_block(((p, q, start) for p, q in pairs), own["copies"].to_numpy(), sets, threshold)
        key = own[["doc_id", "c1", "c2"]]
        both = pd.concat([key, key.iloc[root].add_prefix("to_").reset_index(drop=True)], axis=1).assign(links=links)
        return both[links > 0]

    linked = stash(full.groupBy("unit").applyInPandas(verify, f"doc_id {kind}, c1 long, c2 long, to_doc_id {kind}, to_c1 long, to_c2 long, links long"))
    to = F.struct(F.col("to_doc_id").alias("doc_id"), F.col("to_c1").alias("c1"), F.col("to_c2").alias("c2"))
    groups = connected_components(linked.select(F.struct("doc_id", "c1", "c2").alias("node"), to.alias("to")), "node", "to").select("id.c1", "id.c2", "component")
    links = linked.groupBy("c1", "c2").agg(F.sum("links").alias("links"))
    decided = classes.join(links, ["c1", "c2"], "left").join(groups, ["c1", "c2"], "left")
    first = F.coalesce("component", F.struct(F.col("rep").alias("doc_id"), "c1", "c2"))
    decided = decided.select("c1", "c2", first.alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    decided = stash(decided.select("c1", "c2", "n_links", F.col("first.doc_id").alias("group_id"), ((F.col("first.c1") == F.col("c1")) & (F.col("first.c2") == F.col("c2"))).alias("top")))
    out = seen.select("doc_id", "h", "c1", "c2").join(decided, ["c1", "c2"], "left")
    return out.select(
        "doc_id", "h", "c1", "c2",
        F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("top") & (F.col("doc_id") == F.col("group_id")), F.lit(True)).alias("kept"),
    )


def jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """doc_id, group_id, n_links, kept for every row of ``docs`` (doc_id, text; others are ignored).

    Two documents are linked if the Jaccard index of their sets of ``n``-word sequences is at least
    ``threshold``; a text of fewer words counts as one sequence. ``n_links`` is the number of other rows
    linked directly, ``group_id`` the smallest doc_id reachable by links, ``kept`` whether it is the row's own.
    Texts that are null, empty or blank, and rows without doc_id, link with nothing and are kept. Repeated
    rows are copies of each other; rows of one doc_id with different texts are documents of their own, and of
    those that are linked one is kept. An empty table gives an empty result.

    Equal n-gram sets are one class, and only one document of a class goes on. A bucket of a band with many
    documents is cut into blocks, every pair of blocks is a group of its own, and a group gives back one row
    for each document, never pairs. So a large bucket spreads over many tasks, and nothing is capped.
    """
    return decide(docs, n, threshold, tolerance).select("doc_id", "group_id", "n_links", "kept")


def keep_one(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decide`` keeps, with their columns; of repeated rows and of texts of one
    doc_id with equal n-grams, one."""
    words = F.coalesce("c1", "h")
    kept = decided.filter("kept and doc_id is not null").groupBy("doc_id", words.alias("w"), "c2").agg(F.min("h").alias("h")).select("doc_id", "h")
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.struct("*").alias("row"))
    own = rows.join(kept, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id", "h"])
    return own.unionByName(rows.filter("doc_id is null")).select("row.*")
