"""Words, hashes and connected components."""

import numpy as np
import pyarrow as pa

from rollcall.llm import common
from rollcall.llm.words import gram_hashes, hash_words, sliding_argmin, slices, split_words


def test_words_are_cut_at_ascii_white_space_only():
    flat, count = split_words(pa.chunked_array([pa.array([" a  b\tc\n", None, "", " \x0b ", "x y z\x1cw"])]))
    assert flat.to_pylist() == ["a", "b", "c", "x y", "z\x1cw"] and count.tolist() == [3, 0, 0, 0, 2]


def test_hashes_tell_words_apart_and_do_not_depend_on_place():
    words = [f"w{i}" for i in range(2000)] + ["x" * n for n in range(60, 200)] + ["ab" * 64, "ba" * 64]
    h = hash_words(pa.array(words))
    assert len(set(h.tolist())) == len(words)
    assert (hash_words(pa.array(["zz", *words]).slice(1)) == h).all()
    assert (gram_hashes(h, 3)[5:] == gram_hashes(h[5:], 3)).all()


def test_sliding_argmin():
    v = np.random.default_rng(1).integers(0, 9, 300).astype(np.uint64)
    for width in (1, 2, 7, 16):
        assert sliding_argmin(v, width).tolist() == [i + int(v[i : i + width].argmin()) for i in range(301 - width)]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 4_000_000, None, "y" * 9_000_000, "z", ""], "i": [0, 1, 2, 3, 4]})
    pieces = list(slices(iter([batch])))
    assert [i for p in pieces for i in p.column("i").to_pylist()] == [0, 1, 2, 3, 4] and len(pieces) > 1


def test_components_against_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000, k) for k in range(1001, 1080)] + [(k, k + 1) for k in range(2000, 2040)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in common.connected_components(spark.createDataFrame(edges, "u long, v long"), "u", "v").collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert common.connected_components(spark.createDataFrame([], "u long, v long"), "u", "v").count() == 0
