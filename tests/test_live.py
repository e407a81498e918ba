"""Folds in pieces and on streams, sources with pushdown and cursor, changed documents, point reads."""

import itertools
import json
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rollcall.operators import segments
from rollcall.sources import readers, writers
from rollcall.streaming import live

WORDS = "g string, idx long, speaker string, t0 double, t1 double, word string"
TURNS = "g string, idx long, t0 double, text string"


def words(rng, n, g):
    t, out = 0.0, []
    for i in range(n):
        t = round(t + rng.choice([0.1, 0.3, 0.3, 1.3, 2.0]), 3)
        out.append((g, i * 3, rng.choice(["a", "a", "a", "b", None]), t, round(t + 0.2, 3), rng.choice(["x", "y.", "z", "no!"])))
    return out


def turns(rng, n, g):
    t, out = 0.0, []
    for i in range(n):
        t += rng.choice([1, 2, 5, 19, -3])
        out.append((g, i, float(t), rng.choice([">> hi", "x" * 90, "  ", None, ">>", "more words", "a > b"])))
    return out


def folded(fold, rows):
    """The fold over all rows of a group, one after the other."""
    out = [x for row in rows for x in fold.push(*row)]
    return [*out, *fold.finish()]


@pytest.mark.parametrize("kind", ["words", "turns"])
def test_a_large_group_is_folded_in_pieces(spark, monkeypatch, kind):
    monkeypatch.setattr(segments, "STRETCH", 40)
    rng = random.Random(2)
    made = [(words if kind == "words" else turns)(rng, n, g) for g, n in (("p", 700), ("q", 30), ("r", 300), ("", 1))]
    rows = spark.createDataFrame(list(itertools.chain(*made)), WORDS if kind == "words" else TURNS)
    fold = segments.WordFold() if kind == "words" else segments.TurnFold()
    got = sorted(map(tuple, segments.fold_segments(rows, ["g"], "idx", fold).collect()))
    want = sorted((r[0][0], *x) for r in made for x in folded(type(fold)(), [row[2:] for row in r]))
    assert got == want and len(want) > 100
    pieces = segments._pieces(rows.filter("g = 'p'"), ["g"], "idx", fold).groupBy("_piece").count()
    assert pieces.count() > 20 and pieces.agg(F.max("count")).first()[0] < 700 / 4
    assert segments.fold_segments(rows.limit(0), ["g"], "idx", fold).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_live_captions_for_any_cut_into_batches(spark, tmp_path, seed):
    rng = random.Random(seed)
    kind = seed % 2
    made = {g: (words if kind else turns)(rng, n, g) for g, n in (("p", 60), ("q", 25))}
    names = [c.split()[0] for c in (WORDS if kind else TURNS).split(", ")]
    lines = [dict(zip(names, row, strict=True)) for g in made for row in made[g]]
    lines.sort(key=lambda r: (r["idx"], r["g"]))
    lines += [{"g": g, "idx": 10**6, "ended": True} for g in made]
    cuts = sorted(rng.sample(range(1, len(lines)), 3))
    fold = segments.WordFold if kind else segments.TurnFold
    source = tmp_path / "in"
    source.mkdir()
    for k, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(lines)], strict=True)):
        (source / f"{k}.json").write_text("\n".join(json.dumps(r) for r in lines[lo:hi]))
        # each cut is a run of its own, which goes on from the checkpoint of the one before
        rows = spark.readStream.schema((WORDS if kind else TURNS) + ", ended boolean").json(str(source)).fillna(False, ["ended"])
        out = live.live_segments(rows, "g", "idx", fold())
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted((g, *x) for g in made for x in folded(fold(), [row[2:] for row in made[g]]))


def test_late_halves_in_either_order(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    day = datetime(2025, 5, 1)
    rows = [("event", "a", "e1", 0), ("recording", "a", "r1", 1), ("recording", "b", "r2", 1), ("event", "b", "e2", 3), ("recording", "c", "r3", 2), ("recording", "b", "r4", 4), ("event", "c", "e3", 30), ("recording", "z", "r9", 40)]
    source = tmp_path / "in"
    source.mkdir()
    try:
        for k, batch in enumerate([rows[:3], rows[3:6], rows[6:7], rows[7:]]):
            (source / f"{k}.json").write_text("\n".join(json.dumps({"kind": a, "key": b, "id": c, "at": (day + timedelta(days=d)).isoformat()}) for a, b, c, d in batch))
            stream = spark.readStream.schema("kind string, key string, id string, at timestamp").option("maxFilesPerTrigger", 1).json(str(source))
            live.late_halves(stream, "7 days").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted((r.key, r.event or "", r.recording, r.matched) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # r3 had no event within a week, e3 came later; r9 waits still
    assert got == [("a", "e1", "r1", True), ("b", "e2", "r2", True), ("b", "e2", "r4", True), ("c", "", "r3", False)]


# sources and sinks


def server(folder):
    """A collection as a server would give it: conditions, order and pages; it writes down what it is asked."""

    def fetch(where, order, top, skip):
        with open(f"{folder}/asked", "a") as f:
            f.write(f"{where}|{order}|{top}|{skip}\n")
        with open(f"{folder}/rows.json") as f:
            rows = json.load(f)
        for part in [p.strip("() ") for p in where.split(" and ") if p]:
            name, op, value = re.match(r"(\w+) (eq|gt|ge|lt|le|ne) (.*)", part).groups()
            if op == "ne":
                rows = [r for r in rows if r[name] is not None]
                continue
            value = re.sub(r"^(?:datetime)?'(.*)'$", r"\1", value)
            value = value if "'" in part else int(value)
            rows = [r for r in rows if r[name] is not None and {"eq": r[name] == value, "gt": r[name] > value, "ge": r[name] >= value, "lt": r[name] < value, "le": r[name] <= value}[op]]
        if order:
            name, way = order.split()
            rows = sorted(rows, key=lambda r: r[name], reverse=way == "desc")
        return rows[skip : skip + top]

    return fetch


def test_conditions_are_pushed_to_the_server(spark, tmp_path):
    rows = [{"Id": i, "Body": f"b{i % 3}", "Modified": f"2025-05-{1 + i % 28:02}T00:00:00"} for i in range(95)]
    (tmp_path / "rows.json").write_text(json.dumps(rows))
    schema, columns = "Id long, Body string, Modified string", {"Id": "Id", "Modified": "Modified"}
    spark.dataSource.register(readers.paged_source("plain_pages", schema, server(str(tmp_path))))
    spark.dataSource.register(readers.paged_source("pushing_pages", schema, server(str(tmp_path)), columns))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = lambda name: spark.read.format(name).option("pageSize", 10).load().filter("Modified > '2025-05-20T00:00:00' and Id >= 30 and Body = 'b1' and length(Body) = 2")
        want = sorted(map(tuple, some("plain_pages").collect()))
        (tmp_path / "asked").unlink()
        assert sorted(map(tuple, some("pushing_pages").collect())) == want and want
        asked = (tmp_path / "asked").read_text().splitlines()
        assert len(asked) <= 3 and all("Modified gt datetime'2025-05-20T00:00:00'" in a and "Id ge 30" in a and "Body" not in a for a in asked)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_stream_goes_on_from_its_cursor(spark, tmp_path):
    stamp = lambda d: f"2025-05-{d:02}T00:00:00"
    spark.dataSource.register(readers.paged_source("cursor_pages", "Id long, Modified string", server(str(tmp_path)), {"Modified": "Modified"}, "Modified"))
    rows, seen = [], []
    for run, days in enumerate([[2, 3, 3], [], [4, 9], [9, 10]]):
        rows += [{"Id": 10 * run + k, "Modified": stamp(d)} for k, d in enumerate(days) if (run, k) != (3, 0)]
        (tmp_path / "rows.json").write_text(json.dumps(rows))
        stream = spark.readStream.format("cursor_pages").option("pageSize", 2).load()
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(once=True).start().awaitTermination()
        seen.append(sorted(r.Id for r in spark.read.parquet(str(tmp_path / "out")).collect()))
    assert seen == [[0, 1, 2], [0, 1, 2], [0, 1, 2, 20, 21], [0, 1, 2, 20, 21, 31]]


def test_changed_documents_only(spark, tmp_path):
    folder = str(tmp_path / "docs")
    files = lambda: sorted(str(p) for p in (tmp_path / "docs").rglob("*.txt"))
    docs = spark.createDataFrame([("a", 1), ("b", 2)], "slug string, n int")
    versions = {tuple(r) for r in writers.changed_document_files(docs, folder).collect()}
    first = files()
    assert len(first) == 2
    writers.changed_document_files(docs, folder)
    assert files() == first  # a rerun writes nothing
    writers.changed_document_files(docs.withColumn("n", F.when(F.col("slug") == "a", 9).otherwise(F.col("n"))), folder)
    assert len(files()) == 3 and set(first) < set(files())
    there = spark.read.text(folder)
    assert {(r.slug, r.version) for r in there.collect()} > versions and json.loads(there.filter("slug = 'b'").first().value) == {"slug": "b", "n": 2}
    broken = docs.withColumn("n", F.when(F.col("slug") == "b", F.raise_error(F.lit("no"))).otherwise(F.lit("77")))
    with pytest.raises(Exception, match="no"):
        writers.changed_document_files(broken.repartition(2), folder)
    assert len(files()) == 3  # a failed task leaves nothing


def test_a_point_read_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "points")
    writers.point_table(spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), "id"), path, "key", 16)
    found = writers.point_rows(spark, path, "key", "k777", 16)
    assert [tuple(r) for r in found.collect()] == [("k777", 777)]
    plan = found._jdf.queryExecution().executedPlan()
    read = plan.collectLeaves().apply(0).metrics().apply("numFiles").value()
    assert read == 1 and len(list((tmp_path / "points").rglob("*.parquet"))) == 16
    assert writers.point_rows(spark, path, "key", "none", 16).count() == 0
