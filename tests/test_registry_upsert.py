"""The registry's status values, and the upsert of a batch against a replay row by row."""

import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators import graph, registry

SCHEMA = "meeting_key string, legistar_event_id long, viebit_filename string, body_name string, discover_status string, fetch_status string, prepare_status string, transcribe_status string, diarize_status string, name_speakers_status string, chapterize_status string, discovered_at string, created_at string, updated_at string, cost_usd double"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
WORDS = {"fetch_status": "fetched", "prepare_status": "prepared", "transcribe_status": "transcribed", "diarize_status": "diarized", "name_speakers_status": "named", "chapterize_status": "chapterized"}
NOW = "2025-06-01T00:00:00Z"


def test_mixed_stages(spark):
    stages = list(WORDS)
    rows = [("all", *WORDS.values(), "2025-05-01", "Parks", 0), ("some", "fetched", "prepared", "pending", "stubbed", "stubbed", "stubbed", "2025-05-01", None, 0), ("other", *["done"] * 6, "2025-05-01", "", 9)]
    df = spark.createDataFrame(rows, "k string, " + ", ".join(f"{s} string" for s in stages) + ", event_date string, body_name string, process_attempts long")
    keys = lambda out: sorted(r.k for r in out.collect())
    assert keys(registry.pending(df, "2025-01-01", stages, F.col("event_date"))) == ["some"]
    assert keys(registry.publishable(df, ["transcribe_status", "name_speakers_status", "chapterize_status"], "body_name")) == ["all"]
    assert keys(registry.parked(df, "chapterize_status")) == ["other"]
    assert keys(registry.candidates(df, "prepare_status", "transcribe_status", [F.col("k")])) == ["some"]
    assert keys(registry.downgrade(df, df.limit(0), "k", "fetch_status").filter("fetch_status = 'pending'")) == ["all", "some"]
    merged = df.select(registry.merged_status("chapterize_status", F.lit("chapterized"), F.lit("pending")), registry.merged_status("fetch_status", F.lit("done"), F.lit("pending"))).first()
    assert tuple(merged) == ("chapterized", "pending")


def replay(table, feed):
    """One row after the other, over a list."""
    table = [dict(r) for r in table]
    for new in feed:
        values = {c: v for c, v in new.items() if c in COLUMNS and v is not None} | {"updated_at": NOW}
        values.setdefault("discover_status", "discovered")
        event, file = values.get("legistar_event_id"), values.get("viebit_filename")
        a = next((r for r in table if event is not None and r["legistar_event_id"] == event), None)
        b = next((r for r in table if file and r["viebit_filename"] == file), None)
        if a and b and a is not b:
            untouched = all(b[s] == "pending" or (b[s] == "stubbed" and s not in ("fetch_status", "prepare_status")) for s in WORDS)
            keep, drop = (a, b) if all(a[s] == w for s, w in WORDS.items()) and untouched else (b, a)
            for c in COLUMNS[1:]:
                if c in WORDS:
                    if not (keep[c] == WORDS[c] and drop[c] != WORDS[c]):
                        keep[c] = drop[c]
                elif keep[c] is None:
                    keep[c] = drop[c]
            table = [r for r in table if r is not drop]
            row = keep
        else:
            row = a or b
        if row:
            row.update({c: v for c, v in values.items() if c != "meeting_key" and not (c == "discovered_at" and row["discovered_at"])})
        else:
            key = file.removesuffix(".mp4") if file else f"event-{event}"
            start = {"fetch_status": "pending", "prepare_status": "pending"} | dict.fromkeys(list(WORDS)[2:], "stubbed")
            table.append(dict.fromkeys(COLUMNS) | start | {"meeting_key": key, "created_at": NOW, "discovered_at": NOW} | values)
    return table


@pytest.mark.parametrize("seed", range(3))
def test_batch_upsert_against_a_replay(spark, seed):
    rng = random.Random(seed)
    word = lambda s: rng.choice([WORDS[s], WORDS[s], "pending", "stubbed", "failed"])
    table, n = [], 40
    for i in range(n):  # identifiers are unique in the registry
        event, file = rng.choice([(i, None), (None, f"f{i}.mp4"), (i, f"f{i}.mp4")])
        style = rng.random()
        stages = {s: WORDS[s] if style < 0.3 else ("pending" if s in ("fetch_status", "prepare_status") else "stubbed") if style < 0.6 else word(s) for s in WORDS}
        table.append(dict.fromkeys(COLUMNS) | stages | {"meeting_key": f"m{i}", "legistar_event_id": event, "viebit_filename": file, "body_name": rng.choice([None, f"b{i}"]), "discovered_at": rng.choice([None, "", "d"]), "cost_usd": rng.choice([None, 0.5])})
    feed = []
    for k in range(90):
        i = rng.randrange(n + 20)
        j = i if rng.random() < 0.6 else min(n + 19, i + rng.randrange(2))
        event, file = rng.choice([(i, None), (None, f"f{j}.mp4"), (i, f"f{j}.mp4")])
        feed.append({"legistar_event_id": event, "viebit_filename": file, "body_name": rng.choice([None, f"x{k}"]), "discovered_at": rng.choice([None, f"d{k}"]), "created_at": rng.choice([None, None, f"c{k}"]), "cost_usd": rng.choice([None, float(k)]), "ord": k})
    frame = spark.createDataFrame(table, SCHEMA)
    batch = spark.createDataFrame(feed, "legistar_event_id long, viebit_filename string, body_name string, discovered_at string, created_at string, cost_usd double, ord int")
    batch = batch.unionByName(batch.filter("ord = 3").withColumns({"legistar_event_id": F.lit(None).cast("long"), "viebit_filename": F.lit(""), "ord": F.lit(900)}))  # no identifier
    got = [r.asDict() for r in registry.upsert_batch(frame, batch, NOW).collect()]
    key = lambda r: r["meeting_key"]
    assert sorted(got, key=key) == sorted(replay(table, feed), key=key)


def test_batch_upsert_of_one_hot_event_and_of_nothing(spark):
    frame = spark.createDataFrame([("m", 1, "f.mp4", *[None] * 12), ("n", 2, None, *[None] * 12)], SCHEMA)
    many = spark.range(5000).select(F.lit(1).cast("long").alias("legistar_event_id"), F.col("id").alias("ord"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("body_name"), F.lit(None).cast("string").alias("viebit_filename"))
    got = {r.meeting_key: r for r in registry.upsert_batch(frame, many, NOW).collect()}
    assert got["m"].body_name == "b4999" and got["m"].updated_at == NOW and got["n"].updated_at is None
    assert registry.upsert_batch(frame, many.limit(0), NOW).count() == 2
    taken = many.limit(1).withColumns({"legistar_event_id": F.lit(None).cast("long"), "viebit_filename": F.lit("m.mp4")})
    with pytest.raises(Exception, match="taken"):
        registry.upsert_batch(frame, taken, NOW).collect()


def test_batch_upsert_replays_many_components_a_task(spark):
    n = 200
    empty = dict.fromkeys(COLUMNS)
    table = [empty | {"meeting_key": f"e{i}", "legistar_event_id": i} for i in range(n)] + [empty | {"meeting_key": f"f{i}", "viebit_filename": f"f{i}.mp4"} for i in range(n)]
    feed = [{"legistar_event_id": i % n, "viebit_filename": f"f{i % n}.mp4" if i < n else None, "body_name": f"b{i}", "ord": i} for i in range(3 * n)]
    frame = spark.createDataFrame(table, SCHEMA)
    batch = spark.createDataFrame(feed, "legistar_event_id long, viebit_filename string, body_name string, ord int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # components go over the borders of batches
    try:
        out = registry.upsert_batch(frame, batch, NOW)
        got = [r.asDict() for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    key = lambda r: r["meeting_key"]
    assert sorted(got, key=key) == sorted(replay(table, feed), key=key) and len(got) == n
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()  # a batch for each component


def test_components_against_a_search(spark):
    rng = random.Random(1)
    edges = [(f"n{rng.randrange(150)}", f"n{rng.randrange(150)}") for _ in range(110)] + [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)] + [("s", "s"), (None, "x")]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a:
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    assert got == {x: find(x) for x in list(root)}
    assert graph.components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0
