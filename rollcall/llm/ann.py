"""Approximate nearest neighbours: one hierarchical navigable small-world graph for each shard.

A graph is a few flat arrays: for each layer the nodes and, for each node, a fixed number of neighbour
positions. Layers are built from the top, nodes are inserted in batches, and a whole batch of searches
goes through a layer in step, so that the work is numpy's. Graphs are stored once; queries are sent to them
in bounded blocks, and the shards' results are merged by distance.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rollcall.llm.common import stash
from rollcall.llm.vectors import common_length, flat_matrix, usable


@dataclass
class Layer:
    nodes: np.ndarray  # positions of the vectors in this layer
    row: np.ndarray  # for each vector its row below, or -1
    near: np.ndarray  # flat neighbour array, -1 where there are fewer


def squared(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``a`` (n, d) to its own candidates ``b`` (n, m, d) of squared lengths ``sizes``."""
    return np.maximum((a * a).sum(-1)[:, None] + sizes - 2 * np.matmul(b, a[:, :, None])[:, :, 0], 0)


def diverse(vectors: np.ndarray, cand: np.ndarray, dist: np.ndarray, keep: int) -> np.ndarray:
    """For each row the chosen candidates, -1 where there are fewer. Nearest first, a candidate is
    chosen if it is nearer to the row's own vector than to any chosen one; the nearest others fill up."""
    order = np.argsort(dist, 1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    v = vectors[np.maximum(cand, 0)]
    sq = (v * v).sum(-1)
    between = sq[:, :, None] + sq[:, None, :] - 2 * v @ v.transpose(0, 2, 1)
    n, m = cand.shape
    closest, chosen = np.full((n, m), np.inf, between.dtype), np.zeros((n, m), bool)
    for j in range(m):
        take = (dist[:, j] < closest[:, j]) & np.isfinite(dist[:, j]) & (chosen.sum(1) < keep)
        chosen[:, j] = take
        rows = np.flatnonzero(take)
        closest[rows] = np.minimum(closest[rows], between[rows, j])
    rank = np.where(np.isfinite(dist), np.arange(m) + np.where(chosen, 0, m), 3 * m)
    best = np.argsort(rank, 1, kind="stable")[:, :keep]
    out = np.take_along_axis(cand, best, 1)
    out[np.take_along_axis(rank, best, 1) >= 3 * m] = -1
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


class Hnsw:
    """Graph over distinct vectors, and the ids of each vector's rows.

    Vectors stay in the precision of their column, which is enough to walk the graph by; scores are computed
    from them in double precision."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, links: int, beam: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.vectors, which = np.unique(vectors[order], axis=0, return_inverse=True)
        which = which.ravel()
        self.sizes = (self.vectors * self.vectors).sum(1)
        by = np.argsort(which, kind="stable")
        self.ids, self.begin = ids[order][by], np.searchsorted(which[by], np.arange(len(self.vectors) + 1))
        n = len(self.vectors)
        rng = np.random.Generator(np.random.PCG64(n))
        level = np.floor(-np.log(1 - rng.random(n)) / np.log(links)).astype(int)
        self.layers: list[Layer] = []  # from the top
        for k in range(int(level.max()), -1, -1):
            self._build(rng.permutation(np.flatnonzero(level >= k)), links * (2 if k == 0 else 1), beam)

    def _far(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return squared(queries, self.vectors[nodes], self.sizes[nodes])

    def _build(self, nodes: np.ndarray, degree: int, beam: int) -> None:
        if self.layers:  # nodes of the layer above come first
            nodes = nodes[np.argsort(self.layers[-1].row[nodes] < 0, kind="stable")]
        row = np.full(len(self.vectors), -1)
        row[nodes] = np.arange(len(nodes))
        layer, above = Layer(nodes, row, np.full((len(nodes), degree), -1)), list(self.layers)
        done = 0
        while done < len(nodes):
            new = nodes[done : done + min(max(64, done), 256)]
            v = self.vectors[new]
            mates = np.maximum(self.sizes[new][:, None] + self.sizes[new] - 2 * v @ v.T, 0)
            np.fill_diagonal(mates, np.inf)
            near = np.argsort(mates, 1)[:, : min(len(new), degree if done else 2 * degree)]
            cand, dist = new[near], np.take_along_axis(mates, near, 1)
            if done:
                entry = self._descend(v, above) if above else np.full((len(new), 1), nodes[0])
                found, far = self._walk(v, np.where(row[entry] >= 0, entry, nodes[0]), layer, beam)
                cand, dist = np.concatenate([found, cand], 1), np.concatenate([far, dist], 1)
            layer.near[done : done + len(new)] = diverse(self.vectors, cand, dist, degree)
            self._link_back(layer, new)
            done += len(new)
        self.layers.append(layer)

    def _link_back(self, layer: Layer, new: np.ndarray) -> None:
        own = layer.near[layer.row[new]]
        src, dst = np.repeat(new, own.shape[1]), own.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        targets, at, times = np.unique(dst, return_index=True, return_counts=True)
        for lo in range(0, len(targets), 512):
            t, a, c = targets[lo : lo + 512], at[lo : lo + 512], times[lo : lo + 512]
            more = np.full((len(t), int(c.max(initial=0))), -1)
            k = np.repeat(np.arange(len(t)), c)
            more[k, np.arange(len(k)) - np.repeat(np.cumsum(c) - c, c)] = src[np.repeat(a - (np.cumsum(c) - c), c) + np.arange(len(k))]
            old = layer.near[layer.row[t]]
            more[(more[:, :, None] == old[:, None, :]).any(2)] = -1
            cand = np.concatenate([old, more], 1)
            dist = np.where(cand >= 0, self._far(self.vectors[t], np.maximum(cand, 0)), np.inf)
            layer.near[layer.row[t]] = diverse(self.vectors, cand, dist, old.shape[1])

    def _descend(self, queries: np.ndarray, layers: list[Layer]) -> np.ndarray:
        entry = np.full((len(queries), 1), layers[0].nodes[0])
        for layer in layers:
            entry, _ = self._walk(queries, entry, layer, 8)
            entry = np.where(entry >= 0, entry, entry[:, :1])
        return entry

    def _walk(self, queries: np.ndarray, entry: np.ndarray, layer: Layer, beam: int, steps: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries in step: (nodes, squared distances), -1 and inf if fewer.

        In each step every query expands its ``steps`` nearest unexpanded nodes; a query ends when all
        nodes in its beam are expanded."""
        b = len(queries)
        seen = np.zeros((b, len(self.vectors) + 1), bool)
        ids, dist, open_ = np.full((b, beam), -1), np.full((b, beam), np.inf), np.zeros((b, beam), bool)
        rows, fresh = np.arange(b), entry
        while len(rows):
            fresh = np.where(np.take_along_axis(seen[rows], fresh, 1), -1, fresh)
            fresh = np.sort(fresh, 1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            seen[rows[:, None], fresh] = True
            seen[:, -1] = False
            d = np.where(fresh >= 0, self._far(queries[rows], np.maximum(fresh, 0)), np.inf)
            all_ids, all_d = np.concatenate([ids[rows], fresh], 1), np.concatenate([dist[rows], d], 1)
            all_open = np.concatenate([open_[rows], fresh >= 0], 1)
            best = np.argsort(all_d, 1, kind="stable")[:, :beam]
            ids[rows], dist[rows] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_d, best, 1)
            open_[rows] = np.take_along_axis(all_open, best, 1)
            rows = np.flatnonzero(open_.any(1))
            pick = np.argsort(np.where(open_[rows], dist[rows], np.inf), 1, kind="stable")[:, :steps]
            live = np.take_along_axis(open_[rows], pick, 1)
            node = np.where(live, np.take_along_axis(ids[rows], pick, 1), -1)
            open_[rows[:, None], pick] = False
            near = layer.near[layer.row[np.maximum(node, 0)]]
            fresh = np.where(live[:, :, None], near, -1).reshape(len(rows), live.shape[1] * near.shape[-1])
        return ids, dist

    def flat(self) -> bytes:
        """The graph's arrays, one after the other."""
        arrays = [self.vectors, self.ids, self.begin, *(a for x in self.layers for a in (x.nodes, x.near.astype(np.int32)))]
        return pickle.dumps(arrays)

    @classmethod
    def read(cls, data: bytes) -> Hnsw:
        graph = cls.__new__(cls)
        graph.vectors, graph.ids, graph.begin, *rest = pickle.loads(data)
        graph.layers, graph.sizes = [], (graph.vectors * graph.vectors).sum(1)
        for nodes, near in zip(rest[::2], rest[1::2], strict=True):
            row = np.full(len(graph.vectors), -1)
            row[nodes] = np.arange(len(nodes))
            graph.layers.append(Layer(nodes, row, near))
        return graph

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> list[tuple[int, int, float]]:
        """(query id, id, distance) of the ``k`` nearest other rows of each query."""
        out = []
        for lo in range(0, len(queries), 256):
            q = queries[lo : lo + 256].astype(self.vectors.dtype)
            if len(self.vectors) <= beam:
                found = np.broadcast_to(np.arange(len(self.vectors)), (len(q), len(self.vectors)))
            else:
                upper = self.layers[:-1]
                entry = self._descend(q, upper) if upper else np.full((len(q), 1), self.layers[-1].nodes[0])
                found, _ = self._walk(q, entry, self.layers[-1], beam)
            for own, v, nodes in zip(query_ids[lo : lo + 256], queries[lo : lo + 256].astype(np.float64), found, strict=True):
                nodes = nodes[nodes >= 0]
                far = np.sqrt(((self.vectors[nodes].astype(np.float64) - v) ** 2).sum(1))  # exactly, on the original vectors
                best = []
                for i in np.lexsort((self.ids[self.begin[nodes]], far)):
                    if len(best) >= k and far[i] > best[k - 1][2]:
                        break
                    a, b = self.begin[nodes[i]], self.begin[nodes[i] + 1]
                    best += [(own, x, far[i]) for x in self.ids[a : min(b, a + k + 1)] if x != own]
                out += sorted(best, key=lambda r: (r[2], r[1]))[:k]
        return out


#: A shard has at least so many rows where there are enough; fewer make poor use of a graph.
LEAST_ROWS = 8192


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 131_072, links: int = 16, build_beam: int = 64, beam: int = 128, block_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the ``k`` nearest rows of ``vectors``
    (vec_id, embedding) to each row of ``queries`` (the same columns); others are ignored.

    A row with the query's own vec_id is no candidate. Vectors that are null, empty, zero, or hold
    null or non-finite components, and those that differ in length from most, take no part. Of rows that
    repeat a vec_id the smallest vector counts. Ties go to the smaller vec_id; with fewer candidates than
    ``k`` all are returned. Empty tables give an empty result.

    Rows are dealt evenly over shards: as many as the cluster has cores, as long as a shard has LEAST_ROWS
    rows, and more if one would have over ``shard_rows`` (some 90 MB of graph at 64 dimensions). A task builds
    the graph of one shard. Queries go to the graphs in blocks of at most ``block_rows``, which bounds what is
    broadcast; a block's tasks read each graph once, where it lies, and no graph is shuffled or copied.
    A shard of at most ``beam`` different vectors is scanned, as its beam would hold them all.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = vectors.select("vec_id", "embedding").filter(usable("embedding") & F.col("vec_id").isNotNull())
    dim = common_length(rows, "embedding")
    rows = rows.filter(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    n = rows.count()
    shards = max(1, -(-n // shard_rows), min(spark.sparkContext.defaultParallelism, n // LEAST_ROWS))
    asked = queries.select("vec_id", "embedding").filter(usable("embedding") & F.col("vec_id").isNotNull() & (F.size("embedding") == dim))
    asked = stash(asked.groupBy("vec_id").agg(F.min("embedding").alias("embedding")))
    blocks = max(1, -(-asked.count() // (block_rows // 2)))  # a hash fills blocks unevenly

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if parts:
            whole = pa.Table.from_batches(parts)
            graph = Hnsw(whole.column("vec_id").to_numpy(), flat_matrix(whole.column("embedding"), dim), links, build_beam)
            yield pa.RecordBatch.from_arrays([pa.array([graph.flat()], pa.large_binary()).cast(pa.binary())], ["graph"])

    dealt = rows.repartitionById(shards, F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    index = stash(dealt.mapInArrow(build, "graph binary"))

    found = [spark.createDataFrame([], f"query_id {kind}, vec_id {kind}, score double")]
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        if own.num_rows:
            sent = spark.sparkContext.broadcast((own.column("vec_id").to_numpy(), flat_matrix(own.column("embedding"), dim)))
            found.append(stash(_search(index, sent, k, beam, kind)))
            sent.destroy()
    best = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    every = reduce(DataFrame.unionByName, found)
    return every.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search(index: DataFrame, asked: Broadcast, k: int, beam: int, kind: str) -> DataFrame:
    """The ``k`` nearest of each broadcast query in every graph."""

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, queries = asked.value
        for frame in frames:
            for data in frame["graph"]:
                graph = Hnsw.read(data)
                for lo in range(0, len(ids), 1024):
                    yield pd.DataFrame(graph.search(ids[lo : lo + 1024], queries[lo : lo + 1024], k, beam), columns=["query_id", "vec_id", "score"])

    return index.mapInPandas(search, f"query_id {kind}, vec_id {kind}, score double")
