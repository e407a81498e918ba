"""Repair of replies, the ledger of answers, facets and hints."""

import json

import pytest
from pyspark.sql import functions as F

from rollcall import model_io
from rollcall.functions.json_repair import repair, repaired_json
from rollcall.operators import documents, sequence

# broken replies and what is meant
BROKEN = [
    ('{"a": 1}', {"a": 1}),
    ("{a: 1, b_c: two words, d: true}", {"a": 1, "b_c": "two words", "d": True}),
    ("{'a': 'it''s', 'b': \"x\"}", {"a": "it''s", "b": "x"}),
    ("{'a': 'it's fine', 'b': 2}", {"a": "it's fine", "b": 2}),
    ('{"a": "he said "no" to it", "b": 1}', {"a": 'he said "no" to it', "b": 1}),
    ('{"a": "he said "no", twice", "b": 1}', {"a": 'he said "no", twice', "b": 1}),
    ('{"a": [1, 2, {"b": "c"', {"a": [1, 2, {"b": "c"}]}),
    ('{"a": "cut in the mid', {"a": "cut in the mid"}),
    ('{"a": 1 "b": 2}', {"a": 1, "b": 2}),
    ('{"a": "x" "b": "y"}', {"a": "x", "b": "y"}),
    ('["x"\n "y"\n]', ["x", "y"]),
    ('[1, 2,, 3,]', [1, 2, 3]),
    ('{"a": 1,, "b": 2,}', {"a": 1, "b": 2}),
    ('{"a": // first\n 1, /* second */ "b": 2}', {"a": 1, "b": 2}),
    ('{"a": True, "b": None, "c": FALSE}', {"a": True, "b": None, "c": False}),
    ('{"a": , "b": 2}', {"a": None, "b": 2}),
    ('{"a": [{"b": 1}}', {"a": [{"b": 1}]}),
    ('{"a": {"b": [1, 2]], "c": 3}', {"a": {"b": [1, 2]}}),
    ('Sure! Here it is:\n```json\n{"a": [1]}\n```\nAnything else?', {"a": [1]}),
    ("{“a”: “b”}", {"a": "b"}),
    ('{"a": "x\\n\\"y\\" \\u00e9 \\q"}', {"a": 'x\n"y" é q'}),
    ('{"a": -1.5e3, "b": 007, "c": 1.2.3}', {"a": -1500.0, "b": "007", "c": "1.2.3"}),
    ('{"t": "first\nsecond"}', {"t": "first\nsecond"}),
    ("{}", {}),
    ("[", []),
]


@pytest.mark.parametrize("text, meant", BROKEN)
def test_repair(text, meant):
    assert json.loads(repair(text)) == meant


def test_repair_takes_what_is_whole_as_it_is():
    for value in ({"a": [1, {"b": None}], "c": "x, \"y\": {z}", "d": "it's", "e": "a: b"}, [[], {}, "", 0, -0.5, True], {"k'": "“q”", "u": "😀"}):
        assert json.loads(repair(json.dumps(value))) == value
        assert json.loads(repair(json.dumps(value, indent=2, ensure_ascii=False).encode("utf-16", "surrogatepass").decode("utf-16"))) == json.loads(json.dumps(value).encode().decode())
    assert repair(None) is None and repair("no value") is None and repair("") is None
    for junk in ("{" * 200, "[" * 50 + "}" * 50, '{"a"', "{:::", '{"a": "b\\'):
        json.loads(repair(junk))


def test_repaired_json_as_a_column(spark):
    rows = spark.createDataFrame([(0, '{"a": 1}'), (1, "x {a: 2"), (2, None), (3, "none")], "i int, t string")
    got = [r.x for r in sorted(rows.select("i", repaired_json(F.col("t")).alias("x")).collect())]
    assert got == ['{"a": 1}', '{"a": 2}', None, None]


def test_answers_survive_a_killed_run(spark, tmp_path):
    requests = spark.createDataFrame([(f"k{i}", f"text {i}", 0.5) for i in range(40)], "key string, text string, heat double")
    folder, log = str(tmp_path / "answers"), str(tmp_path / "log")
    broken = tmp_path / "broken"
    broken.write_text("")

    def backend(frame):
        import os

        if "k7" in set(frame["key"]) and os.path.exists(str(broken)):
            raise RuntimeError("killed")
        with open(log, "a") as f:
            f.writelines(f"{k}\n" for k in frame["key"])
        return [{"key": k, "reply": t.upper()} for k, t in zip(frame["key"], frame["text"], strict=True)]

    ask = lambda r: model_io.answered(r, backend, "key string, reply string", folder, "key", "heat", lots=6)
    with pytest.raises(Exception, match="killed"):
        ask(requests)
    stored = {r.key for r in spark.read.parquet(folder).collect()}
    broken.unlink()
    got = {r.key: r.reply for r in ask(requests).collect()}
    asked = open(log).read().split()
    assert got == {f"k{i}": f"TEXT {i}" for i in range(40)}
    assert 0 < len(stored) < 40 and set(asked) == set(got) and all(asked.count(k) == 1 for k in stored)  # what was written is not asked again
    changed = requests.withColumn("text", F.when(F.col("key") == "k3", F.lit("new")).otherwise(F.col("text")))
    assert {r.key: r.reply for r in ask(changed).collect()}["k3"] == "NEW" and open(log).read().split()[len(asked) :] == ["k3"]
    assert ask(requests.limit(0)).count() == 0


def test_facets(spark):
    rows = spark.createDataFrame([(i % 4, v, f"u{i % 9}") for i, v in enumerate(["éclair", "zoo", "eel", "zoo", "Eel", "éclair", "apple"] * 30)], "part int, v string, who string")
    got = [(r.label, r.n, r.place) for r in documents.label_facets(rows, "v").orderBy("place").collect()]
    assert [g[0] for g in got] == ["Éclair", "Eel", "Zoo", "Apple"]  # not behind the unaccented letters
    merged = {r.value: (r.n, r.who) for r in documents.merged_facets(documents.facet_parts(rows.withColumnRenamed("v", "value"), "part", "value", "who"), "value").collect()}
    whole = {r.value: (r.n, r.who) for r in rows.groupBy(F.col("v").alias("value")).agg(F.count("*").alias("n"), F.count_distinct("who").alias("who")).collect()}
    assert merged == whole


def test_facets_of_many(spark):
    rows = spark.range(60000).select((F.col("id") % 5).alias("part"), F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("value"), F.when(F.col("id") % 7 > 0, F.col("id") % 40000).alias("who"))
    merged = {r.value: (r.n, r.who) for r in documents.merged_facets(documents.facet_parts(rows, "part", "value", "who"), "value").collect()}
    whole = {r.value: (r.n, r.who) for r in rows.groupBy("value").agg(F.count("*").alias("n"), F.count_distinct("who").alias("who")).collect()}
    assert merged == whole and merged["a"][1] > 20000


def test_hints(spark):
    said = ["good day", "I'm here", "to talk. My name is Bo Li from here", "and I am glad", "We call the next panel", None, "PANEL two", "my name is bo li"]
    rows = spark.createDataFrame([("m", i, 61.5 * i, t) for i, t in enumerate(said)], "g string, idx int, t0 double, text string")
    got = [r.hint for r in sequence.speaker_hints(rows, "g", ("FROM",)).orderBy("place").collect()]
    # later windows name the same person once more, so that the panel is no hint of its own
    assert got == ["[1] 0:01:01: possible named speaker Bo Li | I'm here to talk. My name is Bo Li from here and I am glad We call the next panel"]
    panel = rows.filter("idx < 7 and idx <> 2")
    assert [r.hint for r in sequence.speaker_hints(panel, "g").collect()] == ["[4] 0:04:06: possible panel introduction | We call the next panel  PANEL two", "[6] 0:06:09: possible panel introduction | PANEL two"]
    assert len(sequence.speaker_hints(panel, "g", (), 1).collect()) == 1 and sequence.speaker_hints(rows.limit(0), "g").count() == 0
