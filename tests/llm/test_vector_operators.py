"""Vector operators against brute force, and with odd rows."""

import numpy as np
import pytest

from rollcall.llm import ann, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, score double, shard int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base + rng.normal(scale=0.04, size=base.shape) for _ in range(10)] + [np.repeat(base[:1], 30, 0)]).astype(np.float32)
    rows = [(i, v.tolist(), i % 3, 0.5, 1) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [1.0] * 3, [float("inf")] * 16]
    rows += [(1000 + i, v, 0, 0.5, 1) for i, v in enumerate(odd)] + [(2000, x[0].tolist(), None, 0.5, 1), (None, x[0].tolist(), 0, 0.5, 1)]
    return spark.createDataFrame(rows, SCHEMA).cache(), x


def test_nearest_recall(spark, vectors):
    df, x = vectors
    df = df.filter("vec_id < 1000")
    queries = df.filter("vec_id % 10 = 0")
    got = ann.nearest(df, queries, k=10, shard_rows=200, beam=48).toPandas()
    d = np.sqrt(((x.astype(float)[:, None] - x.astype(float)[None]) ** 2).sum(2))
    hit = total = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 11)) and q not in set(g.vec_id)
        assert np.allclose(g.score, d[q][g.vec_id])
        assert list(zip(g.score, g.vec_id, strict=True)) == sorted(zip(g.score, g.vec_id, strict=True))
        best = sorted((d[q][i], i) for i in range(len(x)) if i != q)[:10]
        hit += len({i for _, i in best} & set(g.vec_id))
        total += 10
    assert got.query_id.nunique() == queries.count() and hit / total >= 0.9


def test_nearest_recall_as_the_query_asks(spark, monkeypatch):
    """64 dimensions without any structure and the query's own parameters; several shards, several blocks."""
    monkeypatch.setattr(ann, "LEAST_ROWS", 2500)
    x = np.random.default_rng(8).normal(size=(8000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(df, df.filter("vec_id % 100 = 0"), k=10, block_rows=64).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        d = ((x.astype(float) - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(set(np.argsort(d)[:10]) & set(g.vec_id))
    assert len(got) == 800 and hit / 800 >= 0.95


def test_nearest_odd_rows(spark, vectors):
    df, x = vectors
    got = ann.nearest(df, df.filter("vec_id in (0, 600, 1003, 2000)"), k=5).toPandas()
    assert set(got.query_id) == {0, 600, 2000}
    # copies of the query's vector at distance 0, smaller ids first
    assert list(got[got.query_id == 600].sort_values("rank").vec_id) == [601, 602, 603, 604, 605]
    few = df.filter("vec_id in (1, 2, 3)")
    assert ann.nearest(few, few, k=10).count() == 6
    twice = few.unionByName(few)
    assert ann.nearest(twice, twice, k=10).count() == 6
    assert ann.nearest(df.filter("false"), df.filter("false")).count() == 0


@pytest.mark.parametrize("block", [16, 1024])
def test_links_against_brute_force(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    df, x = vectors
    got = {r.vec_id: r for r in vector_dedup.link_vectors(df).collect()}
    assert len(got) == df.count()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    label = np.arange(len(x)) % 3
    near = (u @ u.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    for _ in range(len(x)):
        new = np.minimum(root, np.where(near, root[None], 10**6).min(1))
        if (new == root).all():
            break
        root = new
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist()
    assert [got[i].component_id for i in range(len(x))] == root.tolist()
    for i in [*range(1000, 1007), 2000]:
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert got[None].n_links == 0 and got[None].kept
    assert vector_dedup.link_vectors(df.filter("false")).count() == 0


def test_traversal_visits_every_cell_in_reach():
    rng = np.random.default_rng(7)
    a, b = rng.random((20, 9)), rng.random((20, 9))
    own_a, own_b = rng.integers(0, 9, 20), rng.integers(0, 9, 20)
    a[np.arange(20), own_a] = b[np.arange(20), own_b] = 0
    vector, code, prefix, sequence = vector_dedup.traverse(a, b, 0.8)
    got = [(v, i, j) for v, i, n in zip(vector, code, prefix, strict=True) for j in sequence[v, :n]]
    want = {(v, i, j) for v in range(20) for i in range(9) for j in range(9) if a[v, i] + b[v, j] <= 0.8}
    assert set(got) == want and len(got) == len(want)
    vector, code, count, second = vector_dedup.visits(own_a, own_b, a, b, 0.8)
    at = np.repeat(np.arange(len(vector)), count)
    ahead = {(v, i, j) for v, i, j in want if (i, j) >= (own_a[v], own_b[v])}
    assert set(zip(vector[at], code[at], second, strict=True)) == ahead


def test_links_of_one_id_with_several_vectors(spark):
    """Rows that share a vec_id with other vectors or labels are vectors of their own."""
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (2, b, 0), (3, a, 1), (3, a, 0), (4, [1.0, 0.001, 0.0, 0.0], 1)]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()]
    assert sorted(got) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False)]


def test_links_at_the_threshold_are_decided_on_the_originals(spark):
    x = [3.0, 4.0, 0.0, 0.0]  # cosine with the first axis is exactly 0.6
    rows = [(1, [1.0, 0.0, 0.0, 0.0], 0), (2, x, 0), (3, [2.9999, 4.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in vector_dedup.link_vectors(df, threshold=0.6).collect()} == {1: 1, 2: 2, 3: 1}


def test_copies_of_a_vector_in_the_index_stay_few():
    """The codes that a vector is sent to, and the rows that it meets, grow far slower than the table."""
    met = []
    for n in (4000, 16000):
        x = vector_dedup.unit(np.random.default_rng(n).normal(size=(n, 64)))
        books = [vector_dedup.codebook(y[:2000], int(np.sqrt(n))) for y in (x[:, :32], x[:, 32:])]
        (a, far_a), (b, far_b) = (vector_dedup.least_squares_away(y, c) for y, c in zip((x[:, :32], x[:, 32:]), books, strict=True))
        size = np.bincount(a * 1000 + b, minlength=10**6)
        vector, code, count, second = vector_dedup.visits(a[:500], b[:500], far_a[:500], far_b[:500], 0.04)
        met.append((len(vector) / 500, size[np.repeat(code, count) * 1000 + second].sum() / 500))
    assert met[0][0] < 20 and met[1][0] < 1.6 * met[0][0] and met[1][1] < 2 * met[0][1]


def test_visitors_go_only_to_blocks_that_they_visit(spark, monkeypatch):
    """With blocks of a tenth of a code the vectors sent are far fewer than with each vector in each block."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 20)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[700:] = x[:800] + rng.normal(size=(800, 16)).astype(np.float32) * 0.02
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    real = vector_dedup.link_unit
    counted = spark.sparkContext.accumulator(0)

    def link_unit(ids, *rest):
        counted.add(len(ids))
        return real(ids, *rest)

    monkeypatch.setattr(vector_dedup, "link_unit", link_unit)
    got = {r.vec_id: r.n_links for r in vector_dedup.link_vectors(df, most_codes=4).collect()}
    z = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = z @ z.T >= 0.98
    assert [got[i] for i in range(len(x))] == (near.sum(1) - 1).tolist()
    assert counted.value < 60 * len(x)
