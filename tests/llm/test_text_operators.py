"""Operators on texts against brute force, and with odd rows."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import chat, common, licenses, mixing, ngram_join, packing, passages, quality, sharding
from rollcall.llm.queries import ORACLE_SQL, QUERIES, byte_bpe
from tests.compare import duck, rows

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, cluster string"


def documents(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "src0", len(t or ""), 1.0, 2, "x") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, tiny, long, repeated and equal texts; a row twice, one without doc_id."""
    base = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \n\t ", "one two", "one two", base, base, base + " end", " ".join(f"w{i % 97}" for i in range(30000)), "ñ é 中文 <|endoftext|>"]
    docs = documents(spark, texts)
    return docs.unionByName(docs.filter("doc_id = 5")).unionByName(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long"))).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE_SQL)))
def test_query_matches_sql(spark, name):
    assert rows(QUERIES[name](spark, FOLDER).toPandas()) == rows(duck(FOLDER).sql(ORACLE_SQL[name]).df())


# n-gram join


def brute_links(texts, n=5, t=0.8):
    sets = []
    for x in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", x or "")
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return [{j for j, b in enumerate(sets) if j != i and a and b and len(a & b) / len(a | b) >= t} for i, a in enumerate(sets)]


def groups(links):
    root = list(range(len(links)))
    for _ in links:
        root = [min([root[i], *(root[j] for j in links[i])]) for i in range(len(links))]
    return root


def test_ngram_join_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 7)  # several blocks in a cluster
    rng = np.random.default_rng(1)
    texts = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(0, 12))):
            other = list(base)
            for k in rng.integers(0, 150, int(rng.integers(0, 6))):
                other[k] = f"x{rng.integers(0, 9)}"
            texts.append(" ".join(other))
    got = {r.doc_id: r for r in ngram_join.jaccard_join(documents(spark, texts)).collect()}
    links = brute_links(texts)
    assert [got[i].n_links for i in range(len(texts))] == [len(x) for x in links]
    assert [got[i].group_id for i in range(len(texts))] == groups(links)
    assert all(r.kept == (r.doc_id == r.group_id) for r in got.values())


def test_ngram_join_odd_rows(spark, odd):
    decided = ngram_join.decide(odd)
    got = decided.collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert [by[i].n_links for i in range(3)] == [0, 0, 0]
    assert by[4].group_id == 3 and by[6].group_id == 5 and by[7].group_id == 5
    assert by[6].n_links == 3  # doc 5 twice and doc 7
    kept = ngram_join.keep_one(odd, decided)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 5, 8, 9]
    assert ngram_join.jaccard_join(empty(spark)).count() == 0


def test_ngram_join_tells_texts_of_one_id_apart(spark):
    base = [f"w{i}" for i in range(80)]
    near, other = " ".join([*base[:79], "end"]), " ".join(f"v{i}" for i in range(50))
    docs = documents(spark, [" ".join(base)]).unionByName(documents(spark, [other, near, " "])).unionByName(documents(spark, [near + " ", None], 7))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") < 7, F.lit(0)).otherwise(F.col("doc_id")).cast("long"))
    decided = ngram_join.decide(docs)
    assert sorted((r.doc_id, r.group_id, r.n_links) for r in decided.collect()) == [(0, 0, 0), (0, 0, 0), (0, 0, 2), (0, 0, 2), (7, 0, 2), (8, 8, 0)]
    kept = sorted((r.doc_id, r.text or "") for r in ngram_join.keep_one(docs, decided).collect())
    # the other text and the blank one stay, and one of the three near copies
    assert len(kept) == 4 and (0, other) in kept and (0, " ") in kept and (8, "") in kept
    assert sum(t in (" ".join(base), near) for _, t in kept) == 1


def test_ngram_join_of_a_chain_compares_few_pairs(spark, monkeypatch):
    """Texts that share bands with their neighbours in a chain, but are not similar to most of it: what
    is compared grows with the chain's length, not with its square."""
    rng = np.random.default_rng(9)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 6000)]
    texts = [" ".join(words[i * 20 : i * 20 + 200]) for i in range(280)]  # neighbours at 0.82, next ones at 0.67
    links = brute_links(texts)
    assert {len(x) for x in links} == {1, 2}
    met = spark.sparkContext.accumulator(0)
    plain = ngram_join.surviving_pairs

    def counted(sig_a, sig_b, p, q, plan):
        met.add(len(p))
        return plain(sig_a, sig_b, p, q, plan)

    monkeypatch.setattr(ngram_join, "surviving_pairs", counted)
    got = {r.doc_id: r for r in ngram_join.jaccard_join(documents(spark, texts)).collect()}
    assert [got[i].n_links for i in range(280)] == [len(x) for x in links]
    assert {r.group_id for r in got.values()} == {0}
    assert 0 < met.value < 280 * 60  # all pairs of the chain, twice, would be 78,120


def test_posterior_table():
    plan = dict(ngram_join.least_matches(0.8, 1e-6))
    assert plan[ngram_join.HASHES] <= 0.8 * ngram_join.HASHES
    # a pair at the threshold is dropped at any step with a tiny probability only
    for n, least in plan.items():
        rng = np.random.default_rng(n)
        assert (rng.binomial(n, 0.8, 20000) < least).mean() < 1e-3


# passages


def brute_passages(texts, n=20):
    seen, out = set(), []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for s in range(len(w) - n + 1):
            key = tuple(w[s : s + n])
            if key in seen:
                gone |= set(range(s, s + n))
            seen.add(key)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), kept))
    return out


@pytest.mark.parametrize("shard", [3, 4000])
def test_passages_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(passages, "SHARD_TEXTS", shard)
    rng = np.random.default_rng(2)
    pool = [[f"p{k}w{i}" for i in range(int(rng.integers(18, 60)))] for k in range(5)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(4):
            parts += [f"r{x}" for x in rng.integers(0, 10**6, int(rng.integers(0, 30)))]
            parts += pool[int(rng.integers(0, 5))][int(rng.integers(0, 5)) :]
        texts.append(" ".join(parts))
    texts += ["ha " * 90, "ha " * 70, "a b " * 40]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in passages.remove_repeats(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts)


def test_passages_odd_rows(spark, odd):
    out = passages.remove_repeats(odd).collect()
    assert len(out) == odd.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    want = brute_passages([r.text for r in sorted((r for r in odd.distinct().collect() if r.doc_id is not None), key=lambda r: r.doc_id)])
    assert [(by[i][0].n_words, by[i][0].n_removed, by[i][0].kept_text) for i in range(10)] == want
    assert len(by[5]) == 2 and by[5][0] == by[5][1] and by[None][0].n_removed == 0
    cut = passages.cut_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert {r.doc_id: r.text for r in cut.collect()}[2] == " \n\t "
    assert passages.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("width", [5, 31, 35])
def test_passages_of_other_widths(spark, width):
    rng = np.random.default_rng(width)
    shared = [f"s{i}" for i in range(60)]
    texts = [" ".join([f"r{x}" for x in rng.integers(0, 10**6, 9)] + shared[int(rng.integers(0, 9)) :]) for _ in range(25)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in passages.remove_repeats(documents(spark, texts), width=width).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts, width)


def test_passages_refuse_widths_that_they_cannot_hold(spark, odd):
    for width in (4, 36):
        with pytest.raises(ValueError, match="width"):
            passages.remove_repeats(odd, width=width)


def test_automaton_knows_first_places():
    m = passages.SuffixAutomaton()
    m.add(list("abcabx"), 100)
    m.add(list("zabcab"), 40)
    m.finish()
    assert m.first_places(list("abcab"), 3) == [43, 44, 45]
    assert m.first_places(list("qabx"), 3) == [-1, 105]


# quality


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    out = QUERIES["op3_quality"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    good, bad = out.score[out.quality == 1].to_numpy(), out.score[out.quality == 0].to_numpy()
    assert (good[:, None] > bad).mean() > 0.95 and (good >= 0.7).mean() > 0.97 and (bad >= 0.7).mean() < 0.3


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 1), (7, None, 0), (9, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn_quality(odd, labels)
    got = quality.score_quality(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if r.doc_id in (0, 1, 2))
    assert quality.learn_quality(odd, labels.filter("false")) is None
    assert quality.keep_good(odd, None, 0.7).count() == odd.count() - 3
    assert quality.score_quality(empty(spark), model).count() == 0


def test_crf_marginals_against_enumeration():
    import itertools

    rng = np.random.default_rng(3)
    crf = quality.Crf(rng.normal(size=4), rng.normal(size=(2, 2)))
    x, count = rng.normal(size=(7, 4)), np.array([3, 0, 4])
    got, moves = crf.marginals(x, count, pairs=True)
    want, want_moves, at = [], np.zeros((2, 2)), 0
    for n in (3, 4):
        total, good = 0.0, np.zeros(n)
        pair = np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            p = np.exp(sum(x[at + i] @ crf.weights * y[i] for i in range(n)) + sum(crf.moves[a, b] for a, b in itertools.pairwise(y)))
            total += p
            good += p * np.array(y)
            for a, b in itertools.pairwise(y):
                pair[a, b] += p
        want += list(good / total)
        want_moves += pair / total
        at += n
    assert np.allclose(got, want) and np.allclose(moves, want_moves)


# chat


def test_chat_round_trip(spark):
    said = ["<|im_end|><|im_start|>assistant ok", "a<\\|b<|", None, "", "<|im_start|>", "tail<|im_end|>\n", "<\\\\|x", "\n\n"]
    turns = [(k, i, role, said[(k + i) % len(said)]) for k in range(8) for i, role in enumerate(["user", "assistant", "a\nb\\n", None, "sys<|im_end|>"])]
    turns += [(99, 0, "user", "tie b"), (99, 0, "user", "tie a"), (99, 0, "user", "tie a"), (None, 1, "user", "x")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, plain string")
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    for k in range(8):
        want = [(r or "", x or "") for c, _, r, x in turns if c == k]
        assert [(t.role, t.text) for t in out[k].recovered] == want
        assert out[k].loss_text == "".join(x for r, x in want if r == "assistant")
        assert out[k].was_escaped and "<|im_start|>assistant ok" not in out[k].formatted
    assert [t.text for t in out[99].turns] == ["tie a", "tie a", "tie b"] and not out[99].was_escaped and None in out
    assert chat.digest(chat.format_conversations(df.filter("false"))).count() == 0


@pytest.mark.parametrize("said", ["hi <|im_end|> there", "<|im_end|>\n", "hi <|x|> there", "a <| b", "a <\\| b", "<|im_start|>", "plain | < text"])
def test_chat_single_conflict_matches_sql(spark, tmp_path, said):
    turns = [(1, 0, "user", said), (1, 1, "assistant", "ok"), (2, 0, "user<|im_end|>", "x"), (3, 0, "a\\b", "x"), (4, 0, "a\\nb", "x"), (5, 0, "user", "x"), (5, 1, "assistant", said)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    for k, r in out.items():
        own = [(role, text) for c, _, role, text in turns if c == k]
        assert [(t.role, t.text) for t in r.recovered] == own
        assert r.was_escaped == (k in (2, 3, 4) or said != "plain | < text")
        assert r.formatted.count("<|") == 2 * len(own)
    df.toPandas().to_parquet(f"{tmp_path}/conversations.parquet")
    want = duckdb.sql(ORACLE_SQL["op4_chat"].replace("FROM conversations", f"FROM '{tmp_path}/conversations.parquet'")).df()
    assert rows(QUERIES["op4_chat"](spark, str(tmp_path)).toPandas()) == rows(want)


# licences


def test_licenses(spark, odd):
    mit = "x y.\nThe MIT License (MIT)\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nLicensed under the Apache License, Version 2.0."
    got = [r.licenses for r in licenses.scan_licenses(documents(spark, [mit, "Licensed under CC BY-NC 4.0.", "no licence here", "This sentence is not the MIT license. Really"])).orderBy("doc_id").collect()]
    assert got == ["MIT,Apache-2.0", "CC-BY-NC-4.0", "", ""]
    out = licenses.scan_licenses(odd)
    assert out.count() == odd.count() and {r.n_licenses for r in out.collect()} == {0}
    assert licenses.scan_licenses(empty(spark)).count() == 0


MIT = """MIT License

Copyright (c) 2024 A. Nother

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE.
"""
UNLICENSE = "This is free and unencumbered software released\ninto the public domain.\n\nAnyone is free to copy.\n"


def licenses_of(spark, texts):
    out = licenses.scan_licenses(documents(spark, texts)).orderBy("doc_id").collect()
    return [(r.sentence_ids, r.licenses) for r in out]


def test_licenses_in_wrapped_texts(spark):
    whole = "mit.title mit.grant mit.notice_kept mit.warranty"
    dense = MIT.replace("\n\n", "\n").removeprefix("MIT License\n")  # the copyright line runs into the grant
    comment = "".join(f" * {x}\n" for x in MIT.split("\n"))
    windows = MIT.replace("\n", "\r\n")
    got = licenses_of(spark, [MIT, dense, comment, windows, UNLICENSE, "MIT\nLicense to\nkill", "The\nMIT License\n(MIT)"])
    assert got == [(whole, "MIT"), (whole.removeprefix("mit.title "), "MIT"), (whole, "MIT"), (whole, "MIT"), ("unlicense.grant", "Unlicense"), ("", ""), ("mit.title", "MIT")]


GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
BSD = """Copyright (c) 2024, A. Nother
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER BE LIABLE.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
RESERVED = "LicenseRef-all-rights-reserved"


@pytest.mark.parametrize("form", ["wrapped", "one line"])
def test_license_rules_with_published_texts(spark, form):
    two = "\n\n".join(x for x in BSD.split("\n\n") if not x.startswith("3."))
    texts = [GPL, GPL.replace("This program", "Foo").replace("software:", "software;"), BSD, two, APACHE, MIT, UNLICENSE]
    if form == "one line":
        texts = ["\n\n".join(" ".join(p.split()) for p in t.split("\n\n")) for t in texts]
    want = ["GPL-3.0-or-later"] * 2 + [f"BSD-3-Clause,{RESERVED}", f"BSD-2-Clause,{RESERVED}", "Apache-2.0", "MIT", "Unlicense"]
    got = licenses_of(spark, texts)
    if form == "one line":  # the copyright line before it is part of the sentence
        want = [x.removesuffix(f",{RESERVED}") for x in want]
    assert [x for _, x in got] == want
    assert got[0][0] == "gpl.free gpl3.grant" and got[2][0].endswith("bsd.grant bsd.endorse bsd.warranty")
    if form == "wrapped":
        titles = ["GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nx", "GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nx", "Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nx"]
        cc = [f"This work is licensed under a Creative Commons\nAttribution{x} 4.0 International License." for x in ("", "-NonCommercial", "-ShareAlike")]
        assert [x for _, x in licenses_of(spark, titles + cc)] == ["GPL-3.0-only", "LGPL-3.0-only", "Apache-2.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0"]


# shards


#: Notices and titles as published, one for each further rule.
NOTICES = {
    "GPL-2.0-or-later": "    This program is free software; you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n    the Free Software Foundation; either version 2 of the License, or\n    (at your option) any later version.\n",
    "GPL-3.0-or-later": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 3 of the License, or\n(at your option) any later version.\n",
    "GPL-2.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.\n",
    "AGPL-3.0-or-later": "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU Affero General Public License as published\n    by the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later version.\n",
    "AGPL-3.0-only": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n",
    "LGPL-2.1-or-later": "    This library is free software; you can redistribute it and/or\n    modify it under the terms of the GNU Lesser General Public\n    License as published by the Free Software Foundation; either\n    version 2.1 of the License, or (at your option) any later version.\n",
    "LGPL-2.1-only": "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n",
    "MPL-2.0": "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.\n",
    "ISC": "ISC License\n\nCopyright (c) 2024, A. Nother\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.\n",
    "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\nTo the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring rights to this software to the public domain\nworldwide. This software is distributed without any warranty.\n",
}


def test_license_notices_as_published(spark):
    got = licenses_of(spark, list(NOTICES.values()))
    assert [found for _, found in got] == list(NOTICES)


def test_shards(spark, odd):
    rng = np.random.default_rng(4)
    texts = ["t" * int(n) + str(i % 150) for i, n in enumerate(rng.integers(1, 4000, 400))] + ["copy me"] * 40
    out = sharding.shard_documents(documents(spark, texts)).toPandas()
    size = out.groupby("shard")["size"].sum()
    assert len(size) == 8 and size.max() - size.min() < 0.05 * size.mean()
    assert (out.groupby("text_crc32")["shard"].nunique() == 1).all()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert (out.sort_values("doc_id")["text_crc32"].to_numpy() == [zlib.crc32(t.encode()) for t in texts]).all()
    got = sharding.shard_documents(odd).toPandas()
    assert len(got) == odd.count() and got["size"].min() == 1
    assert sharding.shard_documents(empty(spark)).count() == 0


# mixing


def brute_shards(points, dims, n):
    """Leaf of each point (weight, coordinates): boxes are cut along their widest dimension at the weight
    nearest to the goal, without bins or passes."""
    shard = np.zeros(len(points), int)

    def split(rows, first, leaves):
        if leaves == 1:
            shard[rows] = first
            return
        w = points["w"].to_numpy()[rows].astype(float)
        at = {d: points[d].to_numpy()[rows] / sharding.SPAN for d in dims}
        wide = max(dims, key=lambda d: ((w * at[d] ** 2).sum() / w.sum() - ((w * at[d]).sum() / w.sum()) ** 2, -dims.index(d)))
        order = rows[np.argsort(points[wide].to_numpy()[rows])]
        goal, total, left = w.sum() * (leaves // 2) / leaves, 0.0, len(order)
        for k, r in enumerate(order):
            more = points["w"].iloc[r]
            if total + more >= goal:
                left = k + 1 if total + more - goal < goal - total else k
                break
            total += more
        split(order[:left], first, leaves // 2)
        split(order[left:], first + leaves // 2, leaves - leaves // 2)

    split(np.arange(len(points)), 0, n)
    return shard


@pytest.mark.parametrize("n", [2, 5, 8])
def test_shard_cuts_against_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, int(s), float(a), int(b)) for i, (s, a, b) in enumerate(zip(rng.integers(1, 500, 300), rng.normal(size=300), rng.integers(0, 6, 300), strict=True))]
    df = spark.createDataFrame(rows, "g long, size long, a double, b long")
    got = sharding.kd_shards(df, ["g"], "size", ["a", "b"], n, tolerance=0.0).orderBy("g").toPandas()
    at = df.withColumn("h2", F.xxhash64("g", F.lit(77)))
    lo, hi = df.agg(F.min("a"), F.max("a")).first()
    points = at.select(F.col("size").alias("w"), sharding._coordinate(F.col("a"), lo, hi).alias("a"), sharding._coordinate(F.col("b").cast("double"), 0.0, 5.0).alias("b")).orderBy("g").toPandas()
    assert got["shard"].tolist() == brute_shards(points, ["a", "b"], n).tolist()


def test_mixing_reaches_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labelled = docs.filter("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("domain"))
    targets = {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1}
    out = mixing.plan_mix(docs, labelled, targets).toPandas()
    mass = {d: sum(p[d] * t * r for p, t, r in zip(out.posteriors, out.text_tokens, out.rate, strict=True)) for d in targets}
    for d, w in targets.items():
        assert abs(mass[d] / sum(mass.values()) - w) < 0.02
    assert out.rate.min() >= 1 and out.rate.max() <= 4 and (out.copies >= 1).all()
    # against the same descent in numpy, one document at a time
    p, t = np.array([[x[d] for d in sorted(targets)] for x in out.posteriors]), out.text_tokens.to_numpy(float)
    w = np.array([targets[d] for d in sorted(targets)])
    share = (p * t[:, None]).sum(0) / (p * t[:, None]).sum(0).sum()
    r, last = np.ones(len(t)), None
    total = (p * t[:, None]).sum()
    goal = w / w.sum() * max(share / (w / w.sum()))
    for k in range(25):
        g = ((p * (t * r)[:, None]).sum(0) / total - goal) / share
        done = abs(g).max() < 1e-3 or (k and abs(g - last).max() < 1e-3)
        r, last = np.clip(r - p @ g, 1, 4), g
        if done:
            break
    assert np.allclose(r, out.rate, atol=1e-6)
    mixed = mixing.mix_documents(docs, labelled, targets)
    assert mixed.columns == docs.columns and mixed.count() == int(out.copies.sum())


@pytest.mark.parametrize("low", [0.0, 1.0])
def test_mixing_reaches_targets_of_rare_languages(spark, low):
    """97/1/1/1 %: rare languages need far more than four copies."""
    said = {"en": "the and of", "fr": "le et des", "de": "der und von", "es": "el y los"}
    langs = ["en"] * 970 + ["fr", "de", "es"] * 10
    docs = spark.createDataFrame([(i, f"{said[x]} x{i} y z", x) for i, x in enumerate(langs)], "doc_id long, text string, lang string")
    labelled = docs.select("doc_id", F.col("lang").alias("domain"))
    targets = {"en": 0.55, "fr": 0.15, "de": 0.15, "es": 0.15}
    plan = mixing.plan_mix(docs, labelled, targets, low=low).cache()
    got = mixing.shares(plan, targets)
    for d, w in targets.items():
        assert got[d]["wanted"] == pytest.approx(w) and got[d]["reached"] == pytest.approx(w, abs=0.002) and got[d]["dealt"] == pytest.approx(w, abs=0.03)
    out = plan.toPandas()
    assert out.rate.max() > 10 and out.rate.min() >= low and (low < 1 or out.copies.min() == 1)
    if low < 1:  # the total stays
        assert (out.rate * out.text_tokens).sum() == pytest.approx(out.text_tokens.sum(), rel=0.01)
    langs = mixing.mix_documents(docs, labelled, targets, low=low).groupBy("lang").count().toPandas().set_index("lang")["count"]
    assert all(langs[d] / langs.sum() == pytest.approx(w, abs=0.03) for d, w in targets.items())


def test_mixing_stops_where_targets_cannot_be_reached(spark):
    points = spark.createDataFrame([([0.7, 0.3], 10.0)], "p array<double>, t double")
    steps = mixing.fit_rates(points, [0.5, 0.5], 1.0, float("inf"))
    rate = mixing._rate(points, "p", "r", steps, 1.0, float("inf")).first().r
    assert 1 <= rate < 2 and len(steps) < 50


def test_mixing_goes_through_many_steps(spark):
    """As many steps as a fit may take are no deep expression, and give the rate of the steps taken one by one."""
    rng = np.random.default_rng(4)
    steps, points = rng.normal(0, 0.3, (1000, 4)), rng.dirichlet([1] * 4, 20)
    df = spark.createDataFrame([(p.tolist(),) for p in points], "p array<double>")
    for low, high in ((1.0, float("inf")), (0.0, 1.5)):
        got = mixing._rate(df, "p", "rate", steps.tolist(), low, high).toPandas()
        for p, rate in zip(got.p, got.rate, strict=True):
            want = min(max(1.0, low), high)
            for g in steps:
                want = max(min(want - sum(a * b for a, b in zip(p, g, strict=True)), high), low)
            assert rate == pytest.approx(want, abs=1e-9)
    assert mixing._rate(df, "p", "rate", [], 1.0, 2.0).agg(F.max("rate")).first()[0] == 1


def test_domains_are_learnt_from_documents_that_are_left(spark):
    """Labels of copies that are gone take no place in the sample, however many they are."""
    said = {"en": "the and of", "fr": "le et des", "de": "der und von", "es": "el y los"}
    langs = list(said) * 25
    docs = spark.createDataFrame([(i, f"{said[x]} x{i}", x) for i, x in enumerate(langs)], "doc_id long, text string, lang string")
    gone = spark.range(100, 40_100).select(F.col("id").alias("doc_id"), F.lit("en").alias("domain"))
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).unionByName(gone)
    model = mixing.learn_domains(docs, labelled, max_rows=40)
    assert model.names == ("de", "en", "es", "fr") and sum(round(p * 40) for p in model.priors) == 40
    told = model.posteriors(docs, "text", "p").select("lang", F.array_position("p", F.array_max("p")).alias("k")).collect()
    assert all(model.names[r.k - 1] == r.lang for r in told)


def test_mixing_odd_rows(spark, odd):
    labelled = spark.createDataFrame([(5, "a"), (8, "b"), (9, None), (None, "b")], "doc_id long, domain string")
    out = mixing.plan_mix(odd, labelled, {"a": 0.5, "b": 0.5})
    assert out.count() == odd.count() and out.filter("text_tokens = 0").count() == 3
    none = mixing.plan_mix(odd, labelled.filter("false"), {"a": 1.0}).collect()
    assert all(r.rate == 1 and r.copies == 1 for r in none)
    assert mixing.mix_documents(odd, labelled, {"a": 1.0}, low=0.0).columns == odd.columns
    assert mixing.plan_mix(empty(spark), labelled, {"a": 1.0}).count() == 0


# packing


@pytest.mark.parametrize("blank", [" ", "\n", "\t ", " \u3000"])
def test_ids_of_long_white_space(monkeypatch, blank):
    """A million characters of white space do not stop the encoder; shorter runs, cut out alike, keep their ids."""
    from rollcall.llm.queries import byte_bpe

    encoder = byte_bpe(added=True)()
    ends = ["x", "", "<|endoftext|>y", "=1", "'s"]
    texts = [f"a b{blank * 40}{e}{blank * 7}c d{e}" for e in ends] + [f"{blank * 40}{e}" for e in ends]
    want = [list(encoder.encode(x)) for x in texts]
    monkeypatch.setattr(packing, "LONG", 5)
    monkeypatch.setattr(packing, "BLANK", packing.re.compile(packing.BLANK.pattern.replace("100000", "5")))
    assert [list(encoder.encode(x)) for x in texts] == want
    monkeypatch.undo()
    long = f"a b{blank * (1_200_000 // len(blank))}x"
    (ids,) = encoder.batch(pa.array([long]))
    assert ids.tolist()[:2] == want[0][:2] and len(ids) > 100


def test_encoder_equals_tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    texts = ["", " ", "a  b", " lead", "tail ", "don't stop\n\nnow", "x  y z", "été ça 中文 字", "a \n b", "<|endoftext|> is text", "1 2  3.14!?", "tab\tsep a", "　wide   em"]
    texts += pa.array(texts).to_pylist()
    got = [x.tolist() for x in byte_bpe()().batch(pa.array(texts))]
    assert got == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_knows_added_tokens(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 2, f"a{end}b", f" {end}  b\n{end}", f"x  {end}", "no token <|endof text|>", "", f"été {end}中 {end} 1"]
    want = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in byte_bpe(added=True)().batch(pa.array(texts))] == want and want[0] == [64, 220, 50256, 275]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op9_packing"](spark, str(tmp_path)).collect()}
    assert [got[i].doc_tokens for i in range(len(texts))] == [len(x) + 1 for x in want]


def check_packing(out, docs, size=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    for doc_id, g in out.groupby("doc_id"):
        ids = np.array([*tok.encode(docs[doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in g.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == list(np.cumsum(g.length) - g.length) and g.length.sum() <= size


def test_packing(spark, odd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(5)
    pieces = packing.pack_documents(docs, byte_bpe(), merge=3)
    out = pieces.toPandas()
    check_packing(out, {r.doc_id: r.text for r in docs.collect()})
    pad = packing.padding(pieces).toPandas()
    assert set(out.doc_id) == {r.doc_id for r in docs.collect()} and pad.used.sum() / pad.padded.sum() > 0.97
    some = odd.filter("doc_id <> 5")
    got = packing.pack_documents(some, byte_bpe()).toPandas()
    check_packing(got, {r.doc_id: r.text for r in some.collect()})
    assert len(set(got.doc_id)) == some.count()
    assert packing.pack_documents(odd, byte_bpe()).filter("doc_id = 5").agg(F.sum("length") / F.max("doc_tokens")).first()[0] == 2
    assert packing.pack_documents(empty(spark), byte_bpe()).count() == 0


def test_pack_stream_bounds():
    rng = np.random.default_rng(5)
    docs = [(i, np.arange(n, dtype=np.uint32)) for i, n in enumerate(rng.integers(1, 300, 500))]
    out = list(packing.pack_stream(iter(docs), 128, 8))
    assert sum(left for left, _ in out) <= 8 and all(0 < w.used <= 128 for _, w in out)
    assert sum(w.used for _, w in out) == sum(len(x) for _, x in docs)
    assert hashlib.md5(b"".join(p[2].tobytes() for _, w in out for p in w.pieces)).hexdigest()


def stage(name):
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)[name]


def test_pipeline(spark):
    import corpus_pipeline

    folder = f"{common.scratch_dir(spark)}/rollcall-pipeline"
    out = corpus_pipeline.run(spark, FOLDER)
    assert len(corpus_pipeline.STAGES) == 5
    got = out.toPandas()
    assert len(got) and (got.groupby("sequence_id").length.sum() <= 2048).all()
    # only the last stage's table is left of the run
    assert [os.listdir(f"{folder}/{x}") for x in os.listdir(folder)] == [["4"]]


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    pdf = docs.orderBy("doc_id").toPandas()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(~quality.held_out())
    scores = quality.text_scores(pa.chunked_array([pa.array(pdf.text, pa.string())]), quality.learn_quality(docs, labels))
    good = stage("quality classifier")(spark, docs, FOLDER)
    assert good.columns == docs.columns and sorted(r.doc_id for r in good.collect()) == pdf.doc_id[scores >= 0.7].tolist()

    root = groups(brute_links(pdf.text))
    one = stage("n-gram Jaccard join")(spark, docs, FOLDER)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == [d for k, d in enumerate(pdf.doc_id) if root[k] == k]

    cut = stage("substring dedup")(spark, docs, FOLDER).orderBy("doc_id").toPandas()
    want = brute_passages(pdf.text)
    assert cut.columns.tolist() == docs.columns and [t.split() for t in cut.text] == [w[2].split() for w in want]
    assert all(a == b for a, b, w in zip(cut.text, pdf.text, want, strict=True) if not w[1])

    mixed = stage("mixing sources to target weights")(spark, docs, FOLDER)
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    from rollcall.llm.queries import TARGETS, language_labels

    plan = mixing.plan_mix(docs, language_labels(spark, FOLDER), TARGETS)
    assert mixed.columns == docs.columns and times == {r.doc_id: r.copies for r in plan.collect()} and min(times.values()) >= 1

    packed = stage("packing")(spark, docs, FOLDER).toPandas()
    check_packing(packed, dict(zip(pdf.doc_id, pdf.text, strict=True)))


def test_pipeline_stages_with_odd_rows(spark, odd):
    """Nulls, empty and long texts, repeated rows, no rows, and columns named as the stages name their own."""
    import corpus_pipeline

    clash = odd.withColumns({c: F.lit("mine") for c in ("_h", "h", "row", "rest", "k", "p", "rate", "copies", "spans", "kept", "y", "x", "domain")})
    for docs in (clash, clash.filter("false")):
        for name, own in corpus_pipeline.STAGES:
            out = own(spark, docs, FOLDER)
            if name != "packing":
                assert out.columns == docs.columns
                assert {r._h for r in out.collect()} <= {"mine"}
            docs = spark.createDataFrame(out.collect(), out.schema) if name != "packing" else docs
        assert out.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0] <= 2048


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    class Elsewhere:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Elsewhere()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.scratch_dir(Session())
