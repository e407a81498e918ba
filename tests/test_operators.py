"""Operators on small literal tables."""

from pyspark.sql import functions as F

from rollcall import model_io
from rollcall.operators import costs, documents, fuzzy, intervals, registry, sequence, terms
from rollcall.plans import catalogue
from rollcall.sources import readers, writers
from rollcall.streaming import incremental


def test_labels_by_overlap_then_midpoint(spark):
    rows = spark.createDataFrame([("m", 0, 0.0, 5.0), ("m", 1, 10.0, 11.0), ("m", 2, 30.0, 31.0)], "m string, idx long, t0 double, t1 double")
    turns = spark.createDataFrame([("m", 0, 0.0, 3.0, "A"), ("m", 1, 3.0, 9.0, "B"), ("m", 2, 28.0, 29.0, "C"), ("m", 3, 5.0, 5.0, "X")], "m string, ord long, start double, end double, label string")
    got = intervals.assign_labels(rows, turns, "m").orderBy("idx").collect()
    assert [r.label for r in got] == ["A", "B", "C"]


def test_interval_joins_equal_brute_force_at_all_lengths(spark):
    import random

    rng = random.Random(3)
    length = lambda: rng.choice([0.0, 0.004, 0.2, 3.0, 40.0, 2000.0]) * rng.random()
    rows = [("m", i, t, t + length()) for i, t in enumerate(rng.uniform(-50, 50) for _ in range(120))]
    turns = [("m", i, t, t + length(), f"L{i}") for i, t in enumerate(rng.uniform(-50, 50) for _ in range(120))]
    left = spark.createDataFrame(rows, "m string, idx long, t0 double, t1 double")
    right = spark.createDataFrame(turns, "m string, ord long, start double, end double, label string")

    best = {}
    for _, i, a, b in rows:
        shared = [((min(b, e) - max(a, s)), e - s, -k, x) for _, k, s, e, x in turns if a < e and b > s]
        if shared:
            best[i] = max(shared)[3]
    assert {r.idx: r.label for r in intervals.max_overlap(left, right, "m", 0.01).collect()} == best

    near = {i: min((abs((s + e) / 2 - (a + b) / 2), k, x) for _, k, s, e, x in turns)[2] for _, i, a, b in rows}
    for width in (0.5, 5000.0):
        assert {r.idx: r.label for r in intervals.nearest_midpoint(left, right, "m", width).collect()} == near

    points = left.selectExpr("m", "t0 as t", "idx")
    spans = right.selectExpr("m", "ord as span", "start", "end")
    got = {r.span: sorted(p.idx for p in r.points or []) for r in intervals.contain(spans, points, "m", ["idx"], 0.01).collect()}
    assert got == {k: sorted(i for _, i, a, _ in rows if s <= a < e) for _, k, s, e, _ in turns}

    ranges = [("m", k, int(s * 9), int(e * 9), x) for _, k, s, e, x in turns] + [("m", 900, 7, 3, "none")]
    over = spark.createDataFrame(ranges, "m string, ord long, low long, high long, value string")
    items = spark.range(-400, 400, 7).selectExpr("'m' as m", "id as idx")
    got = {r.idx: r.value for r in intervals.override_ranges(items, over, "m", 1).collect()}
    assert got == {i: max([(k, v) for _, k, a, b, v in ranges if a <= i <= b], default=(0, None))[1] for i in range(-400, 400, 7)}
    # an interval over all time is at most some hundreds of rows
    wide = spark.createDataFrame([("m", 0, 0.0, 4e9)], "m string, idx long, t0 double, t1 double")
    assert intervals.bucketed(wide, "t0", "t1", 60.0, True).count() < 1100


def test_dense_labels(spark):
    rows = spark.createDataFrame([("m", 2.0, "x"), ("m", 1.0, "y"), ("m", 3.0, "y")], "m string, start double, raw string")
    got = sequence.first_appearance(rows, "m", "raw", ["start"]).orderBy("start").collect()
    assert [r.number for r in got] == [0, 1, 0]


def test_words_to_segments(spark):
    words = [("m", 0, "s1", 0.0, 0.3, "one"), ("m", 1, "s1", 0.4, 0.8, "two."), ("m", 2, "s2", 1.0, 1.3, "three"), ("m", 3, "s2", 4.0, 4.2, "four")]
    df = spark.createDataFrame(words, "m string, idx long, speaker string, t0 double, t1 double, word string")
    got = [(r.t0, r.t1, r.speaker, r.words) for r in sequence.fold_words(df, "m").orderBy("t0").collect()]
    assert got == [(0.0, 0.8, "s1", 2), (1.0, 1.3, "s2", 1), (4.0, 4.2, "s2", 1)]


def test_vote_needs_two_items(spark):
    chapters = spark.createDataFrame([("m", 0, "VOTE", 100.0, 200.0), ("m", 1, "VOTE", 300.0, 400.0)], "m string, idx long, kind string, start double, end double")
    items = spark.createDataFrame([("m", 98.0), ("m", 150.0), ("m", 320.0)], "m string, t double")
    got = [tuple(r) for r in sequence.split_votes(chapters, items, "m").orderBy("start").collect()]
    assert got == [("m", 0, "VOICE_VOTE", 98.0, 150.0), ("m", 0, "VOICE_VOTE", 150.0, 200.0), ("m", 1, "VOTE", 300.0, 400.0)]


def test_names_snap_to_one_anchor(spark):
    anchors = spark.createDataFrame([("Shahana Hanif",), ("Lincoln Restler",), ("Ana Reyes",), ("Ana Reyas",)], "anchor string")
    names = spark.createDataFrame([("Shahanna Haneef",), ("Lincon Restler",), ("Ana Reyis",), ("Public",)], "name string")
    got = {r.name: r.anchor for r in fuzzy.snap(names, anchors).collect()}
    assert got == {"Shahanna Haneef": "Shahana Hanif", "Lincon Restler": "Lincoln Restler"}


def test_fuzzy_blocking_loses_nothing(spark):
    import itertools
    import random

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abclmnrst") for _ in range(rng.randint(2, 7)))
    a, b = [f"{word()} {word()}" for _ in range(60)], [f"{word()} {word()}" for _ in range(60)]
    names, anchors = spark.createDataFrame([(x,) for x in a], "name string"), spark.createDataFrame([(x,) for x in b], "anchor string")
    got = {(r.name, r.anchor, r.score) for r in fuzzy.snap(names, anchors).collect()}
    every = spark.createDataFrame(list(itertools.product(a, b)), "name string, anchor string")
    scored = every.withColumn("score", fuzzy.name_score(fuzzy.name_tokens(F.col("name")), fuzzy.name_tokens(F.col("anchor")))).filter("score is not null").collect()
    want = set()
    for n in set(a):
        mine = {(r.score, r.anchor) for r in scored if r.name == n}
        top = [x for x in mine if x[0] == min(mine)[0]] if mine else []
        if len(top) == 1:
            want.add((n, top[0][1], top[0][0]))
    assert got == want


def test_merge_never_regresses(spark):
    reg = spark.createDataFrame([("a", "t", "fetched", "pending", 3, 0.5), ("b", "t", "pending", "chapterized", 2, None)], "meeting_key string, topic string, fetch_status string, chapterize_status string, process_attempts int, cost_usd double")
    feed = spark.createDataFrame([("a", None, "pending", "chapterized", 2, None, "r1"), ("b", "x", "error", "pending", 0, 1.0, "r2"), ("zz", "x", "fetched", "chapterized", 1, 1.0, "r3")], "meeting_key string, topic string, fetch_status string, chapterize_status string, process_attempts int, cost_usd double, ord string")
    got = {r.meeting_key: tuple(r)[1:] for r in registry.merge_results(reg, feed, "meeting_key", ["fetch_status", "chapterize_status"], "process_attempts", "cost_usd").collect()}
    assert got == {"a": (None, "fetched", "chapterized", 3, 0.5), "b": ("x", "error", "chapterized", 0, 1.0)}


def test_schema_evolution_and_keys(spark):
    old = spark.createDataFrame([("k", None)], "meeting_key string, viebit_filename string")
    new = registry.evolve(old)
    row = new.first()
    assert new.columns == registry.REGISTRY.names and row.fetch_status == "pending" and row.chapterize_status == "stubbed" and row.process_attempts == 0
    assert registry.duplicates(new, "viebit_filename").count() == 0 and registry.one(new, "meeting_key", "k").count() == 1


def test_costs(spark):
    col = costs.meeting_cost(F.lit(7200.0), F.lit(None).cast("string"), F.lit(0.04), F.lit(0.02))
    assert spark.range(1).select(col).first()[0] == 0.24
    assert spark.range(1).select(costs.meeting_cost(F.lit(7200.0), F.lit("sync"))).first()[0] == 0.36
    prices = spark.createDataFrame([("m-", 1.0), ("m-large", 2.0)], "prefix string, price double")
    assert costs.price_of(spark.createDataFrame([("m-large-x",)], "model string"), prices).first().price == 2.0


def test_sources(spark, tmp_path):
    (tmp_path / "a.vtt").write_text("WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\nHELLO\n\n00:00:02.000 --> 00:00:03.000\nHELLO\nWORLD\n\n00:00:03.000 --> 00:00:04.000\nWORLD\nAGAIN\n")
    lines = readers.caption_lines(readers.captions(spark, str(tmp_path / "a.vtt")))
    kept = [(t, x) for t, x in [(r.idx, r.text) for r in sequence.drop_rollup(lines, "path").orderBy("idx").collect()]]
    assert [x for _, x in kept] == ["HELLO", "WORLD", "AGAIN"]
    (tmp_path / "r.xml").write_text("<rss><channel><item><title>A_250423-100921.mp4</title><guid>g</guid><pubDate>Wed, 23 Apr 2025 18:42:00 GMT</pubDate></item><item><title></title><guid>h</guid></item></channel></rss>")
    assert [tuple(r) for r in readers.rss(spark, str(tmp_path / "r.xml")).collect()] == [("A_250423-100921", "g", "2025-04-23T18:42:00+00:00")]
    (tmp_path / "roster.csv").write_text("name,district,party,term_start,term_end\nAna Lee,2,X,2024-01-01,2025-12-31\nBo Ray,1,Y,2024-01-01,\n")
    held = registry.in_term(readers.roster(spark, str(tmp_path / "roster.csv")), "term_start", "term_end", F.lit("2025-05-01").cast("date"))
    assert [r.name for r in held.collect()] == ["Ana Lee"]
    assert readers.json_lines(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    (tmp_path / "u.jsonl").write_text('{"meeting_key":"m","idx":0,"start":1.5,"end_sec":2.0,"text":"x"}\n\n')
    assert tuple(readers.utterances(spark, str(tmp_path / "u.jsonl")).first())[2:4] == (1.5, 2.0)
    (tmp_path / "res" / "deep").mkdir(parents=True)
    (tmp_path / "res" / "deep" / "x.json").write_text('{"status":"done","row":{"meeting_key":"m"}}')
    (tmp_path / "res" / "other.json").write_text('{"unrelated": 1}')
    assert [r.meeting_key for r in readers.results(spark, str(tmp_path / "res"), "meeting_key string").collect()] == ["m"]


def test_recording_links(spark):
    import base64

    target = base64.b64encode(b"https://v/player?v=NYCC_250423-100921.mp4").decode()
    page = spark.createDataFrame([(f'<a href="Video.aspx?Mode=Auto&amp;URL={target}">x</a><a href="/y">y</a>',)], "html string")
    assert readers.recording_links(page).first().recordings == ["NYCC_250423-100921"]


def test_paged_source(spark):
    def fetch(where, order, top, skip):
        return [{"id": i, "name": f"{where}{i}"} for i in range(skip, min(skip + top, 25))]

    spark.dataSource.register(readers.paged_source("pages_of_events", "id long, name string", fetch))
    df = spark.read.format("pages_of_events").option("pageSize", 10).option("partitions", 3).option("where", "e").load()
    assert df.count() == 25 and df.rdd.getNumPartitions() == 3


def test_paged_source_reads_to_the_end(spark):
    def fetch(where, order, top, skip):
        return [{"id": i, "name": where} for i in range(skip, min(skip + top, int(where)))]

    spark.dataSource.register(readers.paged_source("all_pages", "id long, name string", fetch))
    for n in (0, 1000, 2500):
        for parts in (1, 4):
            df = spark.read.format("all_pages").option("where", str(n)).option("partitions", parts).load()
            assert sorted(r.id for r in df.collect()) == list(range(n))
    assert readers.modified_since("2025-01-01").startswith("EventLastModifiedUtc gt ")


def test_agenda_items(spark):
    def fetch(event):
        first = [{"EventItemId": 1, "EventItemTitle": "a"}, {"EventItemId": 2, "EventItemAgendaSequence": 7}, {"EventItemId": 3, "EventItemAgendaSequence": 7}]
        return {1: first, 2: [], 3: [{"EventItemId": 9, "EventItemTitle": "b"}]}[event]

    items = readers.agenda_items(spark.createDataFrame([(1,), (2,), (3,), (1,)], "event_id long"), fetch)
    assert items.count() == 4
    assert {(r.event_id, r.EventItemId) for r in readers.first_items(items).collect()} == {(1, 2), (3, 9)}


def test_rollup_in_place(spark):
    texts = [None, "", "a\na\nb\na", "\n".join("abcdefghia")]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = [r.kept for r in df.select("k", sequence.rollup_dropped(F.col("text")).alias("kept")).orderBy("k").collect()]
    assert got == [None, [""], ["a", "b"], list("abcdefghia")]


def test_rollup_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sequence, "PIECE_CHARS", 500)  # pieces end within a batch
    df = spark.range(300).select("id", F.when(F.col("id") % 11 > 0, F.concat_ws("\n", F.lit("x"), F.col("id").cast("string"), F.lit("x"))).alias("text"))
    got = {r.id: r.kept for r in df.coalesce(1).select("id", sequence.rollup_dropped(F.col("text")).alias("kept")).collect()}
    assert got == {i: ["x", str(i)] if i % 11 else None for i in range(300)}


def test_matrix_refuses_more_than_its_limit(spark):
    import pytest

    with pytest.raises(ValueError, match="more than 2"):
        writers.matrix(spark.range(3), "id", limit=2)


def test_documents(spark, tmp_path):
    chapter = lambda i, s: {"id": f"{i:03d}", "slug": s, "type": "REMARKS", "title": s, "summary": "", "start_sec": 0.0, "end_sec": 1.0, "utterances": []}
    rows = [{"slug": "a", "body": "City & Co", "title": "t", "topic": None, "date": "2025-01-02", "time": "01:00 PM", "duration_sec": 9.0, "video": {"url": "u", "poster": "p"}, "summary": ["s"], "tags": ["VOTE"], "chapters": [chapter(1, "x"), chapter(2, "y")]}]
    df = spark.createDataFrame(rows, documents.DOCUMENT)
    assert [(r.path, r.chapter_index) for r in documents.routes(df).collect()] == [("/meetings/city-and-co/a/x", 0), ("/meetings/city-and-co/a/y", 1)]
    one = documents.chapter(df, "a", "y").first()
    assert (one.chapter_index, one.previous, one.next) == (1, "x", None)
    writers.document_files(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).filter("slug = 'a'").count() == 1
    assert writers.matrix(df, "slug", "date") == '[{"slug":"a","date":"2025-01-02"}]'
    assert documents.selected(df, "tags", ["LAND_USE"]).count() == 0


def test_stream_merge_is_idempotent(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "meeting_key string, status string"

    def merge(present, batch):
        new = batch.groupBy("meeting_key").agg(F.max("status").alias("status"))
        return new if present is None else registry.upsert(present, new, "meeting_key")

    def run():
        incremental.merge_stream(spark, str(tmp_path / "in"), schema, str(tmp_path / "t"), str(tmp_path / "c"), merge)
        return {r.meeting_key: r.status for r in incremental.latest_version(spark, str(tmp_path / "t")).collect()}

    (tmp_path / "in" / "1.json").write_text('{"meeting_key":"a","status":"pending"}\n')
    assert run() == {"a": "pending"}
    (tmp_path / "in" / "2.json").write_text('{"meeting_key":"a","status":"done"}\n{"meeting_key":"b","status":"done"}\n')
    assert run() == {"a": "done", "b": "done"} == run()
    # a batch leaves the parts of other keys where they are, and a new checkpoint goes on behind what is there
    (tmp_path / "in" / "3.json").write_text('{"meeting_key":"b","status":"late"}\n')
    assert run() == {"a": "done", "b": "late"}
    versions = lambda: {v: {k for w, k, _ in incremental._versions(spark, str(tmp_path / "t")) if w == v} for v in range(9)}
    assert len(versions()[2]) == 1
    incremental.merge_stream(spark, str(tmp_path / "in"), schema, str(tmp_path / "t"), str(tmp_path / "new"), merge)
    assert {r.meeting_key for r in incremental.latest_version(spark, str(tmp_path / "t")).collect()} == {"a", "b"}
    assert versions()[3] and not versions()[0]


def test_cursor(spark):
    e = spark.createDataFrame([("2025-05-01T00:00:00", "1"), ("2025-06-01T00:00:00", ""), (None, "3")], "m string, id string")
    good, bad = incremental.split_malformed(e, "id", "m")
    assert (good.count(), bad.count()) == (1, 2)
    assert incremental.next_cursor(good, "m", None) == "2025-05-01T00:00:00"
    assert incremental.next_cursor(e, "m", "2025-07-01", True) == "2025-07-01" and incremental.next_cursor(e, "m", "x", False) == "x"
    told = []
    assert len(incremental.from_sources({"bad": lambda: 1 / 0, "good": lambda: e}, told.append)) == 1 and "bad" in told[0]


def test_model_boundary(spark):
    req = spark.createDataFrame([("a", "hi"), ("b", "yo")], "key string, text string")
    assert {tuple(r) for r in model_io.call_model(req, model_io.echo_backend, "key string, reply string").collect()} == {("a", "HI"), ("b", "YO")}
    parts = spark.createDataFrame([("m", 2, 10.0, "_part2", [("x", 1.25, 2.5, "speaker_7"), (" ", 1.0, 2.0, "s"), ("y", 3.0, 3.0, "s")])], "meeting_key string, part int, offset double, suffix string, segments array<struct<text string, start double, end double, speaker_id string>>")
    assert [tuple(r)[2:] for r in model_io.segments(parts).collect()] == [(11.25, 12.5, "x", "speaker_7_part2")]


def test_numbers_wider_than_their_pad_stay_whole(spark, tmp_path):
    n = 1005
    events = spark.range(n).selectExpr("1L as user_id", "id as event_id", "concat('t', id) as event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(n).selectExpr("1L as conv_id", "id as turn", "concat('r', id) as role", "'x and y' as text").write.parquet(f"{tmp_path}/conversations.parquet")
    ids = lambda name, col: [r[col] for r in catalogue.QUERIES[name](spark, str(tmp_path)).orderBy(F.length(col), col).collect()]
    assert ids("first_appearance_labels", "label") == [f"SPK_{i:02d}" for i in range(n)]
    assert ids("prev_next", "id") == [f"{i:03d}" for i in range(1, n + 1)]
    assert ids("verification_candidates", "id") == [f"v{i:03d}" for i in range(1, n + 1)]


REPLY = "meeting_key string, part int, offset double, suffix string, body string"


def vendor(spark, items, body, **options):
    replies = spark.createDataFrame([("m", 2, 10.0, "_part2", body)], REPLY)
    return [tuple(r)[2:] for r in model_io.vendor_segments(replies, items, **options).orderBy("t0").collect()]


def test_vendor_segments_under_other_names_and_times_of_their_words(spark):
    body = '{"segments":[{"transcript":"one  two","start_time":"1.5","end":2,"speaker":"sp 1"},{"start":null,"words":[{"text":"a","start":3,"end":3.5},{"type":"spacing","text":" ","start":3.5,"end":3.6},{"word":"b","start":3.6,"end":4}]},{"text":"x","start":5,"end":5},{"text":" ","start":6,"end":7}]}'
    assert vendor(spark, "segments", body) == [(11.5, 12.0, "one two", "sp_1_part2"), (13.0, 14.0, "a b", "UNKNOWN_part2")]
    assert vendor(spark, "sentences", '{"sentences":[{"text":"hi","start":0,"end":1.0005}]}') == [(10.0, round(11.0005, 3), "hi", "UNKNOWN_part2")]


def test_vendor_replies_without_items_are_made_of_words(spark):
    words = '"words":[{"text":"Hello","start":0,"end":400,"speaker":"A"},{"text":",","start":400,"end":500,"speaker":"A"},{"text":"you","start":600,"end":900,"speaker":"B"}]'
    want = [(10.0, 10.5, "Hello,", "A_part2"), (10.6, 10.9, "you", "B_part2")]
    assert vendor(spark, "utterances", "{" + words + "}", unit=0.001) == want
    assert vendor(spark, "utterances", '{"utterances":[{"text":"","start":1,"end":2}],' + words + "}", unit=0.001) == want
    assert vendor(spark, "utterances", "not json", unit=0.001) == []


def test_vendor_replies_are_read_once_unless_they_name_words(spark):
    word = '[{"text":"a","start":0,"end":1}]'
    bodies = {"name by number": '{"\\u0077ords":' + word + "}", "in an item": '{"segments":[{"words":' + word + '}],"words":[]}', "plain": '{"segments":[{"text":"b  c","start":0,"end":2}]}', "neither": '{"segments":[{"text":"words","start":2,"end":1}]}'}
    rows = [(k, 1, 0.0, "", v) for k, v in bodies.items()] + [("two", 1, 0.0, "", bodies["plain"]), ("two", 1, 0.0, "", '{"words":' + word + "}"), ("two", 2, 0.0, "", '{"words":' + word + "}")]
    out = model_io.vendor_segments(spark.createDataFrame(rows, REPLY), "segments")
    assert sorted((r.meeting_key, r.part, r.text) for r in out.collect()) == [("in an item", 1, "a"), ("name by number", 1, "a"), ("plain", 1, "b c"), ("two", 1, "b c"), ("two", 2, "a")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") < 60  # patterns are not written into each step that names their result


def test_vendor_utterances_cut_at_the_pauses_of_their_words(spark):
    body = '{"utterances":[{"text":"a b","start":0,"end":5000,"speaker":"A","words":[{"text":"a","start":0,"end":400,"speaker":"Z"},{"text":"b","start":4000,"end":5000}]}]}'
    assert vendor(spark, "utterances", body, unit=0.001, by_words=True) == [(10.0, 10.4, "a", "A_part2"), (14.0, 15.0, "b", "A_part2")]
    assert vendor(spark, "utterances", '{"utterances":[{"text":"a b","start":0,"end":5000,"speaker":"A"}]}', unit=0.001, by_words=True) == [(10.0, 15.0, "a b", "A_part2")]


def test_paths_in_three_forms(spark):
    manifest = spark.createDataFrame([("/meetings/b/m/c", 1)], "path string, n int")
    paths = spark.createDataFrame([(x,) for x in ("/meetings/b/m/c", "/meetings/b/m/c/", "/og/chapter/b/m/c.png", "/meetings/b/m", None)], "path string")
    assert sorted(r.asked for r in documents.by_path(manifest, paths).collect()) == ["/meetings/b/m/c", "/meetings/b/m/c/", "/og/chapter/b/m/c.png"]


def test_stamp_and_stale_rows(spark):
    rows = spark.createDataFrame([("a", "f", None, "", "2025-01-01T00:00:00Z"), ("b", "f", 3, None, "2025-01-01"), ("c", "f", None, "soon", "2025-01-01"), ("d", None, None, None, None), ("e", "f", None, "2025-01-20", None)], "k string, viebit_filename string, legistar_event_id long, viebit_pub_date string, discovered_at string")
    now = F.lit("2025-01-22 00:00:00").cast("timestamp")
    # an empty date is earlier than any floor, as it is where the registry compares texts
    assert [r.k for r in registry.stale_unmatched(rows, "", now).collect()] == ["a"]
    assert registry.stale_unmatched(rows, "2025-01-01", now).count() == 0
    stamped = registry.stamp(rows.withColumn("updated_at", F.lit("old")), F.col("k") == "a", F.lit("new")).collect()
    assert [r.updated_at for r in stamped] == ["new", "old", "old", "old", "old"]


def test_documents_sorted_and_indented(spark, tmp_path):
    docs = spark.createDataFrame([("s", None, [(2, 1)])], "slug string, body string, chapters array<struct<z int, a int>>")
    value = writers.snapshots(docs, "slug").first()["value"]
    assert value.index('"body"') < value.index('"chapters"') < value.index('"a"') < value.index('"z"') < value.index('"slug"') and "\n" in value
    writers.document_files(docs, f"{tmp_path}/d", pretty=True)
    back = spark.read.text(f"{tmp_path}/d", wholetext=True).first()["value"]
    assert back.strip() == value


def test_prompt_of_a_group(spark):
    rows = spark.createDataFrame([("m", 1, "b"), ("m", 0, "a")], "m string, i int, t string")
    assert terms.prompt(rows, ["m"], "i", F.col("t"), "{m}: {lines}!").first()["prompt"] == "m: a\nb!"
