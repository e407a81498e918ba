"""Multiset hashes, the filter audit and periodic runs: against brute force, and with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import filter_audit, licenses, mixing, multiset_hash, periodic
from rollcall.llm.queries import TARGETS, language_labels, op13_periodic_runs, planted
from tests.llm.test_text_operators import BSD, FOLDER, MIT, documents, empty, licenses_of, odd  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


# multiset hash


def plain_fingerprint(text):
    sums, marks, pieces = [0] * 8, [0] * 64, 0
    for p in text.split("\n"):
        h = sha(p)
        sums = [(s + int(h[8 * k : 8 * k + 8], 16)) % 2**32 for k, s in enumerate(sums)]
        w = re.findall(WORD, p)
        for i in range(max(1, len(w) - 2) if w else 0):
            bits = f"{int(sha(' '.join(w[i : i + 3]))[:16], 16):064b}"
            marks = [m + int(b) for m, b in zip(marks, bits, strict=True)]
            pieces += 1
    return sums, pieces, marks


def as_text(f):
    return ";".join([",".join(map(str, f[0])), str(f[1]), ",".join(map(str, f[2]))])


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    u, v = ([2 * m - x[1] for m in x[2]] for x in (a, b))
    norms = sum(x * x for x in u + v)
    return max(0.0, 1 - sum((x - y) ** 2 for x, y in zip(u, v, strict=True)) / norms) if norms else 0.0


def plain_edits(docs):
    """docs: (doc_id, text), ids present; rows of one id have one successor, the least text of the next id."""
    ids = sorted({i for i, _ in docs})
    least = {i: min((t or "" for j, t in docs if j == i), key=lambda t: t.encode()) for i in ids}
    out = []
    for i, t in docs:
        t, after = t or "", least[ids[(ids.index(i) + 1) % len(ids)]]
        m = len(t) // 4
        edited = t[: len(t) - m] + after[:m]
        a, b, c = map(plain_fingerprint, (t, edited, after))
        out.append((i, len(t), sha(edited), as_text(a), as_text(b), round(plain_likeness(a, b), 12), round(plain_likeness(a, c), 12)))
    return sorted(out)


def edits(df):
    return sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12)) for r in multiset_hash.compare_edits(df).collect())


@pytest.mark.parametrize("group", [1, 4000])
def test_edits_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(multiset_hash, "GROUP_ROWS", group)
    rng = random.Random(3)
    texts = ["".join(rng.choice(["ab ", "cé\n", "中 ", "\n", "word ", "\t", "x"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    docs = documents(spark, texts).withColumn("doc_id", F.col("doc_id") * F.col("doc_id") - 500)  # gaps
    assert edits(docs) == plain_edits([(r.doc_id, r.text) for r in docs.collect()])
    one = documents(spark, ["only one\nhere"], 7)
    assert edits(one) == plain_edits([(7, "only one\nhere")])


def test_edits_of_odd_rows(spark, odd):  # noqa: F811
    got = multiset_hash.compare_edits(odd).collect()
    assert len(got) == odd.count()
    none = [r for r in got if r.doc_id is None]
    assert len(none) == 1 and none[0].fingerprint == next(r.fingerprint for r in got if r.doc_id == 5)
    assert none[0].near_edited is None and none[0].near_next is None and none[0].edited_sha256 is None
    known = odd.filter("doc_id is not null")
    assert edits(known) == plain_edits([(r.doc_id, r.text) for r in known.collect()])
    assert multiset_hash.compare_edits(empty(spark)).count() == 0
    two = documents(spark, ["b", "a b c", "z"]).withColumn("doc_id", F.when(F.col("doc_id") < 2, F.lit(4)).otherwise(F.lit(1)).cast("long"))
    assert edits(two) == plain_edits([(4, "b"), (4, "a b c"), (1, "z")])


def test_fingerprints_add_up_and_ignore_order(spark):
    parts = ["one two three four", "", "five six", "one two three four"]
    texts = ["\n".join(parts), "\n".join(parts[::-1]), "\n".join(parts[:2]), "\n".join(parts[2:]), "\n".join(parts[:3])]
    f = {r.doc_id: r for r in multiset_hash.fingerprints(documents(spark, texts)).collect()}
    assert f[0].fingerprint == f[1].fingerprint != f[4].fingerprint
    both = multiset_hash.fingerprints(documents(spark, texts)).groupBy().pivot("doc_id", [0, 1, 2, 3, 4]).agg(F.first("fingerprint"))
    plus, minus = multiset_hash.plus(F.col("2"), F.col("3")), multiset_hash.minus(F.col("0"), F.col("3"))
    got = both.select((plus == F.col("0")).alias("p"), (minus == F.col("2")).alias("m"), multiset_hash.to_text(F.col("0")).alias("t")).first()
    assert got.p and got.m and got.t == as_text(plain_fingerprint(texts[0]))


def test_likeness_follows_the_shared_part(spark):
    words = [f"w{i}" for i in range(2000)]
    texts = ["\n".join(" ".join(words[i : i + 10]) for i in range(0, 2000, 10))] + ["\n".join(" ".join(words[i : i + 10]) for i in range(1000 - k, 3000 - k, 10)) for k in (1000, 500, 0)] + ["other things entirely " * 300]
    both = multiset_hash.fingerprints(documents(spark, texts)).groupBy().pivot("doc_id", [0, 1, 2, 3, 4]).agg(F.first("fingerprint"))
    got = both.select(*[multiset_hash.likeness(F.col("0"), F.col(str(k))).alias(f"k{k}") for k in range(1, 5)]).first()
    assert got.k1 == 1.0 and abs(got.k2 - 0.75) < 0.2 and abs(got.k3 - 0.5) < 0.3 and got.k4 < 0.3


# filter audit


def plain_failures(docs):
    first = {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, source in docs:
        t = t or ""
        w = re.findall(WORD, t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        out.append((source or "", {f for f, bad in fails.items() if bad}, i))
    return out


def plain_audit(docs, good, toxic):
    rows, out = plain_failures(docs), Counter()
    for part in {p for p, *_ in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                shapley[f] += sum(f in fails and not fails & set(order[:k]) for _, fails, _ in mine)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [r for r in mine if f in r[1] and not r[1] & before]
                out[part, "".join(order), k + 1, sum(not r[1] & (before | {f}) for r in mine), len(gone), sum(f in r[1] and bool(r[1] & before) for r in mine), sum(r[1] == {f} for r in mine), sum(r[2] in good for r in gone), sum(r[2] in toxic for r in gone), shapley[f]] += 1
    return out


def audited(df):
    return Counter((r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect())


def test_audit_against_brute_force(spark, odd):  # noqa: F811
    rng = random.Random(5)
    texts = [rng.choice(["", "A", "# "]) + " ".join(rng.choice(["Ab", "cd", "e1", "f$", f"w{rng.randrange(99)}"]) for _ in range(rng.choice([0, 3, 60, 60, 80]))) for _ in range(150)]
    texts += rng.choices(texts, k=50) + [None, "", " "]
    docs = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string"))))
    docs = docs.unionByName(odd)  # repeated rows and one without doc_id; their ids begin anew
    labels = spark.createDataFrame([(i, i % 2, i % 5 == 0, "x") for i in range(0, 200, 3)] + [(0, None, None, "x"), (3, 0, True, "y"), (None, 1, True, "z")], "doc_id long, quality int, toxic boolean, source string").withColumn("toxic", F.col("toxic").cast("int"))
    said = labels.filter("doc_id is not null").collect()
    good, toxic = {r.doc_id for r in said if r.quality == 1}, {r.doc_id for r in said if r.toxic == 1}
    got = audited(filter_audit.audit_documents(docs, labels))
    assert got == plain_audit([(r.doc_id, r.text, r.source) for r in docs.collect()], good, toxic)
    assert sum(got.values()) == 120 * 5 * 5
    assert filter_audit.audit_documents(empty(spark), labels).count() == 0
    assert audited(filter_audit.audit_documents(docs, labels.limit(0))) == plain_audit([(r.doc_id, r.text, r.source) for r in docs.collect()], set(), set())


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([(None, True, None, 2), ("", False, True, None), ("p", False, False, 5), (None, True, True, 1)], "part string, X boolean, Y boolean, cost int")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(rows, "XY", ("cost",)).collect()}
    assert len(got) == 3 * 2 * 2
    r = got[None, "XY", 1]
    assert (r.kept, r.removed, r.redundant, r.unique_fails, r.cost_lost, r.shapley) == (0, 2, 0, 1, 3, 3)
    r = got[None, "YX", 2]
    assert (r.kept, r.removed, r.redundant, r.cost_lost, r.shapley) == (0, 1, 1, 2, 3)
    assert got["p", "XY", 2].kept == 1 and got["", "YX", 1].removed == 1
    with pytest.raises(ValueError, match="filters"):
        filter_audit.audit(rows, "ABCDEFGH", ())


# periodic runs


def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            s = k
            while k + q < n and w[k] == w[k + q]:
                k += 1
            size = k + q - s
            if k > s and size >= max(6, 4 * q) and not any(all(w[t] == w[t + r] for t in range(s, s + size - r)) for r in range(1, q)):
                out.append((s, size, q))
            k += k == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(text):
    w = re.findall(WORD, text or "")
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *told, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def plain_planted(doc_id, text):
    w, h = re.findall(WORD, text or ""), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def test_find_runs_against_all_periods():
    rng = random.Random(1)
    for _ in range(1500):
        n, kinds = rng.randrange(0, 60), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randrange(1, 8)
            for i in range(a + p, n):
                w[i] = w[i - p]
        want = plain_runs(w)
        assert periodic.find_runs(w) == want, w
        parts = [(lo + s, k, p) for lo, hi in periodic.stretches(np.array(w, np.int64), np.zeros(n, np.int64)) for s, k, p in periodic.find_runs(w[lo:hi])]
        assert sorted(parts, key=lambda r: (r[0], r[2])) == want
    thue = [bin(i).count("1") % 2 for i in range(1 << 12)]
    assert periodic.find_runs(thue) == []
    assert periodic.find_runs([7] * 5) == [] and periodic.find_runs([7] * 6) == [(0, 6, 1)] and periodic.find_runs([1, 2] * 4) == [(0, 8, 2)]
    assert periodic.find_runs([1, 2, 3] * 30_000 + [9] * 30_000) == [(0, 90_000, 3), (90_000, 30_000, 1)]


def test_extensions_against_the_words():
    rng = random.Random(2)
    w = [rng.randrange(2) for _ in range(300)] * 2
    ext = periodic.Extensions(w)
    for _ in range(2000):
        i, j = sorted(rng.sample(range(len(w) + 1), 2))
        k = ext.ahead(i, j)
        assert w[i : i + k] == w[j : j + k] and (j + k == len(w) or w[i + k] != w[j + k])
        k = ext.behind(i, j)
        assert w[i - k : i] == w[j - k : j] and (i == k or w[i - k - 1] != w[j - k - 1])


def test_runs_of_odd_rows(spark, odd):  # noqa: F811
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    nested = " ".join(["a"] * 7 + ["b"] + ["a"] * 7 + ["b"] + ["a"] * 7 + ["b"] + ["a"] * 7 + ["b", "c"])
    docs = odd.unionByName(documents(spark, [nested, "x " * 6, "é  é\té\né é é !", "y " * 40_000], 20))
    got = periodic.detect_runs(docs, texts=True).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id not in (8, 23):  # long texts: below
            assert tuple(r[c] for c in columns) == plain_digest(texts[r.doc_id]), r.doc_id
    by = {r.doc_id: r for r in got}
    assert by[8].period == 97 and by[8].length == 30_000 and by[23].collapsed_text == "y" and by[23].exponent_milli == 40_000_000
    assert by[21].n_runs == 1 and by[20].n_runs == 5
    assert periodic.detect_runs(empty(spark)).count() == 0


def test_planted_runs_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("n_chars < 4000").select("doc_id", "text").collect()
    want = {r.doc_id: plain_planted(r.doc_id, r.text) for r in docs}
    frame = spark.createDataFrame(docs)
    changed = {r.doc_id: r.t for r in frame.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("t")).collect()}
    assert changed == want and any(want[r.doc_id] != r.text for r in docs)
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r.doc_id: tuple(r[c] for c in columns) for r in op13_periodic_runs(spark, FOLDER).collect()}
    assert all(got[i] == plain_digest(t) for i, t in want.items())


# mixing: what the classifier is worth on rows that it has not learnt from


def test_domains_of_unseen_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labelled = language_labels(spark, folder)
    plan = mixing.plan_mix(docs, labelled, TARGETS).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(abs(sum(p.values()) - 1) < 1e-9 for p in plan.posteriors)
    seen = {r.doc_id for r in labelled.collect()}
    new = plan[~plan.doc_id.isin(seen) & (plan.text_tokens > 20)]
    likeliest = new.posteriors.map(lambda p: max(p, key=p.get))
    assert len(new) > 400 and (likeliest == new.lang).mean() > 0.97
    # calibration: of a language the expected tokens are those that there are
    for d in TARGETS:
        expected = sum(p[d] * t for p, t in zip(new.posteriors, new.text_tokens, strict=True))
        assert abs(expected - new.text_tokens[new.lang == d].sum()) < 0.01 * new.text_tokens.sum()
    dealt = (plan.copies * plan.text_tokens).groupby(plan.lang).sum()
    assert all(abs(dealt[d] / dealt.sum() - w) < 0.02 for d, w in TARGETS.items())


def test_many_copies_are_dealt_over_tasks(spark):
    said = {"en": "the and of", "fr": "le et des"}
    docs = spark.createDataFrame([(i, said["fr" if i == 0 else "en"] + f" x{i}", "fr" if i == 0 else "en") for i in range(400)], "doc_id long, text string, lang string").coalesce(1)
    labelled = docs.select("doc_id", F.col("lang").alias("domain"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task
    mixed = mixing.mix_documents(docs, labelled, {"en": 0.5, "fr": 0.5}).cache()
    rare = mixed.filter("doc_id = 0")
    assert 350 < rare.count() < 450 and rare.select(F.spark_partition_id()).distinct().count() > 1
    assert mixed.filter("doc_id > 0").count() == 399
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# licences: common wordings

WORDINGS = {
    "This project is distributed under the MIT license": "MIT",
    "Code released under the MIT License - see LICENSE": "MIT",
    "// SPDX-License-Identifier: MIT": "MIT",
    "x = 1  # SPDX-License-Identifier: LGPL-2.1-or-later\ny = 2": "LGPL-2.1-or-later",
    "# SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause)": "GPL-2.0-only,BSD-3-Clause",
    "/* SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception */": "Apache-2.0",
    "see http://www.apache.org/licenses/LICENSE-2.0 for more": "Apache-2.0",
    "Dual licensed under the MIT License (https://opensource.org/licenses/MIT)": "MIT",
    "\n".join("# " + x for x in MIT.split("\n\n")[2].split("\n")): "MIT",
    BSD.replace("the copyright holder nor", "Google Inc. nor"): "BSD-3-Clause,LicenseRef-all-rights-reserved",
    "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)": "BSL-1.0",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
    "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:": "Zlib",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.": "0BSD",
    "Released under the GNU GPL v3 or later": "GPL-3.0-or-later",
    "Licensed under the WTFPL": "WTFPL",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.": "OFL-1.1",
    "Licensed under the EUPL, Version 1.2": "EUPL-1.2",
    "Artistic License 2.0\n\nx": "Artistic-2.0",
    "This work is licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
    "MIT No Attribution\n\nCopyright": "MIT-0",
    "It is not licensed under the MIT license.": "",
    "the MIT license is nice": "",
    "ask for permission under the stairs of apache": "",
    "SPDX-License-Identifier: Unknown-1.0": "",
}


def test_common_wordings_of_licences(spark):
    assert dict(zip(WORDINGS, [found for _, found in licenses_of(spark, list(WORDINGS))], strict=True)) == WORDINGS


def test_every_rule_has_its_sentences():
    known = {*licenses.KNOWN.values(), *(i for _, i in licenses.SLOTTED)}
    assert {i for _, _, rule in licenses.RULES for i in rule} <= known
    assert all(any(re.sub("[^a-z0-9]+", " ", c) in sentence for c in licenses.CUES) for sentence in licenses.KNOWN)
