"""Queries over the driver's tables, one for each operator, with SQL that gives the same rows.

The tables stand in for the domain's: conversations for utterances, events for intervals and markers,
orders for the registry, parts and customers for rosters, pages for fetched pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rollcall import model_io
from rollcall.functions import json_repair, scalar, text, timeparse
from rollcall.operators import costs, discovery, documents, fuzzy, intervals, registry, sequence, terms
from rollcall.sources import readers, writers
from rollcall.sources.readers import table
from rollcall.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# Shared views


def utterances(spark: SparkSession, d: str) -> DataFrame:
    """conv_id, idx, label, text, t0: a turn starts where the texts before it end, 50 ms a character."""
    rows = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("idx"), F.col("role").alias("label"), "text")
    before = F.sum(F.length("text") * 50).over(W.partitionBy("conv_id").orderBy("idx").rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("t0", F.coalesce(before, F.lit(0)).cast("double"))


UTTERANCES = """u AS (SELECT conv_id, turn AS idx, role AS label, text, CAST(coalesce(sum(length(text) * 50) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS t0 FROM conversations)"""


def seconds(spark: SparkSession, d: str) -> DataFrame:
    """events with sec: whole seconds since the epoch, as a double."""
    return table(spark, d, "events").withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double"))


SECONDS = "e AS (SELECT *, CAST(floor(epoch(ts)) AS DOUBLE) AS sec FROM events)"


def joined(c, sep: str = ","):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


# Order inside conversations

NORMAL = f"""{UTTERANCES}, n AS (SELECT *, coalesce(lead(t0) OVER (PARTITION BY conv_id ORDER BY idx), t0 + 4000) AS nx FROM u),
  norm AS (SELECT conv_id, idx, label, t0, CASE WHEN nx <= t0 THEN greatest(t0 + 500, nx) ELSE nx END AS t1, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM n)"""


@query(f"WITH {NORMAL} SELECT * FROM norm WHERE text <> ''")
def normalize_utterances(spark, d):
    rows = utterances(spark, d).withColumn("t1", F.lit(None).cast("double"))
    return sequence.normalize_utterances(rows, "conv_id", 4000.0, 500.0).select("conv_id", "idx", "label", "t0", "t1", "text")


@query(f"""WITH {NORMAL} SELECT conv_id, label, count(*) AS n, CAST(sum(greatest(t1 - t0, 0)) AS BIGINT) AS ms,
  CAST(sum(greatest(t1 - t0, 0)) AS BIGINT) * 10000 // CAST(sum(sum(greatest(t1 - t0, 0))) OVER (PARTITION BY conv_id) AS BIGINT) AS share_bp, min(idx) AS first_idx, max(idx) AS last_idx
  FROM norm WHERE text <> '' GROUP BY conv_id, label""")
def label_evidence(spark, d):
    return sequence.label_evidence(normalize_utterances(spark, d), "conv_id", "label")


@query("""SELECT conv_id, turn AS idx, role IS DISTINCT FROM lag(role) OVER w AS starts_run, role IS DISTINCT FROM lead(role) OVER w AS ends_run
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def speaker_changes(spark, d):
    return sequence.changes(utterances(spark, d), "conv_id", "label").select("conv_id", "idx", "starts_run", "ends_run")


@query("""SELECT conv_id, turn AS idx, array_to_string(list(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), '|') AS around,
  array_to_string(list(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), '|') AS up_to FROM conversations""")
def context_window_3(spark, d):
    rows = utterances(spark, d)
    return rows.select("conv_id", "idx", F.array_join(sequence.context(rows, "conv_id", "label", 3, 3), "|").alias("around"), F.array_join(sequence.context(rows, "conv_id", "label", 3, 0), "|").alias("up_to"))


@query("""WITH a AS (SELECT conv_id, turn, role, list(struct_pack(r := role, i := turn)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS ahead FROM conversations),
  f AS (SELECT *, list_min(list_transform(list_filter(ahead, lambda x: x.r <> role), lambda x: x.i)) AS stop FROM a)
  SELECT conv_id, turn AS idx, array_to_string(list_transform(list_filter(ahead, lambda x: stop IS NULL OR x.i < stop), lambda x: x.i), ',') AS run FROM f""")
def same_speaker_run(spark, d):
    return sequence.run_ahead(utterances(spark, d), "conv_id", "label", "idx").select("conv_id", "idx", joined(F.col("run")).alias("run"))


@query("""WITH m AS (SELECT user_id, event_id, event_type, min(event_id) OVER (PARTITION BY user_id, event_type) AS f FROM events)
  SELECT user_id, event_id, 'SPK_' || lpad(CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY f) - 1 AS VARCHAR), 2, '0') AS label FROM m""")
def first_appearance_labels(spark, d):
    rows = sequence.first_appearance(table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_type", ["event_id"])
    return rows.select("user_id", "event_id", F.format_string("SPK_%02d", "number").alias("label"))


@query("SELECT user_id, event_id, value FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM events) WHERE m IS NULL OR value > m")
def monotone_filter(spark, d):
    return sequence.increasing(table(spark, d, "events").select("user_id", "event_id", "value"), "user_id", ["event_id"], "value")


@query(f"""WITH {SECONDS}, w AS (SELECT user_id, event_id, sec, lead(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id) AS nx, max(sec) OVER (PARTITION BY user_id) + 5 AS dur,
   CASE WHEN event_type = 'click' THEN sec + floor(value) END AS own FROM e)
  SELECT user_id, event_id, greatest(sec + 1, coalesce(own, nx, dur)) AS end_sec FROM w""")
def chapter_ends(spark, d):
    rows = seconds(spark, d).withColumn("idx", F.col("event_id")).withColumn("duration", F.max("sec").over(W.partitionBy("user_id")) + 5)
    rows = rows.withColumn("own_end", F.when(F.col("event_type") == "click", F.col("sec") + F.floor("value")))
    return sequence.chapter_ends(rows, "user_id", "sec", "duration", "own_end").select("user_id", "event_id", F.col("end_sec").cast("double").alias("end_sec"))


@query("""SELECT conv_id, turn, lag(turn) OVER w AS previous, lead(turn) OVER w AS next, lpad(CAST(row_number() OVER w AS VARCHAR), 3, '0') AS id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def prev_next(spark, d):
    return documents.neighbours(table(spark, d, "conversations"), "conv_id", "turn", "turn").select("conv_id", "turn", "previous", "next", "id")


@query("""WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), i AS (SELECT user_id, n, unnest(range(least(n, 8))) AS k FROM n)
  SELECT user_id, string_agg(DISTINCT CAST(CASE WHEN n <= 8 THEN k ELSE CAST(round_even(k * (n - 1) / 7.0, 0) AS BIGINT) END AS VARCHAR), ',' ORDER BY CAST(CASE WHEN n <= 8 THEN k ELSE CAST(round_even(k * (n - 1) / 7.0, 0) AS BIGINT) END AS VARCHAR)) AS picks FROM i GROUP BY user_id""")
def evenly_spaced_sample(spark, d):
    rows = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    picks = F.transform(sequence.evenly_spaced(F.col("n"), 8), lambda i: i.cast("string"))
    return rows.select("user_id", F.array_join(F.array_sort(picks), ",").alias("picks"))


@query("SELECT c_custkey, c_nationkey, CAST(floor((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) / 40) AS INTEGER) AS chunk FROM customer")
def chunk_labels(spark, d):
    return sequence.fixed_chunks(table(spark, d, "customer").select("c_custkey", "c_nationkey"), ["c_nationkey"], ["c_custkey"], 40)


@query("""WITH RECURSIVE s AS (SELECT conv_id, turn AS idx, length(text) // 4 AS z, max(turn) OVER (PARTITION BY conv_id) + 1 AS n FROM conversations),
  r(conv_id, st, idx, total, n) AS (
    SELECT conv_id, 0, 0, z, n FROM s WHERE idx = 0
    UNION ALL SELECT r.conv_id, CASE WHEN r.total + s.z <= 300 THEN r.st ELSE greatest(r.st + 1, r.idx + 1 - 1) END,
       CASE WHEN r.total + s.z <= 300 THEN r.idx + 1 ELSE greatest(r.st + 1, r.idx) END,
       CASE WHEN r.total + s.z <= 300 THEN r.total + s.z ELSE (SELECT z FROM s s2 WHERE s2.conv_id = r.conv_id AND s2.idx = greatest(r.st + 1, r.idx)) END, r.n
    FROM r JOIN s ON s.conv_id = r.conv_id AND s.idx = r.idx + 1)
  SELECT conv_id, st AS start, max(idx) + 1 AS end FROM r GROUP BY conv_id, st""")
def budget_chunks(spark, d):
    rows = utterances(spark, d).select("conv_id", "idx", F.floor(F.length("text") / 4).cast("long").alias("size"))
    return sequence.budget_chunks(rows, "conv_id", "size", 300, 1)


@query(f"""WITH {UTTERANCES}, r AS (SELECT conv_id, idx, label, unnest([0, 1, 2]) AS k FROM u)
  SELECT conv_id, min(idx) AS start_index, coalesce(lead(min(idx)) OVER (PARTITION BY conv_id ORDER BY min(idx)) - 1, max(max(idx)) OVER (PARTITION BY conv_id)) AS end_index FROM u GROUP BY conv_id, label""")
def ranges_from_starts(spark, d):
    rows = utterances(spark, d).groupBy("conv_id", "label").agg(F.min("idx").alias("start_index"), F.max("idx").alias("top"))
    rows = rows.withColumn("last", F.max("top").over(W.partitionBy("conv_id")))
    return sequence.starts_to_ranges(rows, "conv_id", "last").select("conv_id", "start_index", "end_index")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
  a AS (SELECT doc_id, list(t ORDER BY i) AS ls FROM l GROUP BY doc_id),
  k AS (SELECT doc_id, list_reduce(list_transform(ls, lambda x: [x]), lambda a, x: CASE WHEN list_contains(a[-8:], x[1]) THEN a ELSE list_concat(a, x) END) AS kept FROM a)
  SELECT doc_id, CAST(len(kept) AS BIGINT) AS n, md5(array_to_string(kept, chr(10))) AS digest FROM k""")
def caption_dedupe8(spark, d):
    kept = sequence.rollup_dropped(F.col("text"), 8)
    docs = table(spark, d, "documents").filter("text is not null").withColumn("kept", kept)
    return docs.select("doc_id", F.size("kept").cast("long").alias("n"), F.md5(F.array_join("kept", "\n")).alias("digest"))


@query(f"""WITH {UTTERANCES}, c AS (SELECT conv_id, idx, t0 / 1000 AS t, array_to_string(regexp_extract_all(text, '[^\\s]+'), ' ') AS x FROM u),
  a AS (SELECT conv_id, list(struct_pack(t := t, x := x) ORDER BY idx) AS rs FROM c WHERE x <> '' GROUP BY conv_id),
  f AS (SELECT conv_id, list_reduce(list_transform(rs, lambda r: [r]), lambda a, r: CASE WHEN r[1].t - a[-1].t > 18 OR length(a[-1].x) > 280 THEN list_concat(a, r)
    ELSE list_concat(a[:-2], [struct_pack(t := a[-1].t, x := a[-1].x || ' ' || r[1].x)]) END) AS turns FROM a)
  SELECT conv_id, unnest(list_transform(turns, lambda y: y.t)) AS t_sec, unnest(list_transform(turns, lambda y: y.x)) AS text FROM f""")
def turn_fold(spark, d):
    return sequence.fold_turns(utterances(spark, d).withColumn("t0", F.col("t0") / 1000), "conv_id")


@query(f"""WITH RECURSIVE {UTTERANCES}, w AS (SELECT conv_id, idx, label, t0, array_to_string(regexp_extract_all(text, '[^\\s]+'), ' ') AS x FROM u),
  v AS (SELECT conv_id, label, idx * 1000000 + k - 1 AS o, t0 / 1000 + (k - 1) * 0.3::DOUBLE AS a, t0 / 1000 + (k - 1) * 0.3::DOUBLE + 0.25::DOUBLE AS b, word
    FROM (SELECT conv_id, idx, label, t0, unnest(string_split(x, ' ')) AS word, generate_subscripts(string_split(x, ' '), 1) AS k FROM w)),
  n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY o) AS i FROM v),
  f AS (SELECT conv_id, i, i AS s, label, a AS sa, a, b, word, 1 AS c, word ~ '[.!?]$' AND false AS shut FROM n WHERE i = 1
    UNION ALL
    SELECT n.conv_id, n.i, CASE WHEN z THEN n.i ELSE f.s END, n.label, CASE WHEN z THEN n.a ELSE f.sa END, n.a, n.b, n.word, CASE WHEN z THEN 1 ELSE f.c + 1 END,
      CASE WHEN z THEN 1 ELSE f.c + 1 END >= 4 AND n.b - CASE WHEN z THEN n.a ELSE f.sa END >= 1.0 AND regexp_matches(n.word, '[.!?]$')
    FROM f JOIN n ON n.conv_id = f.conv_id AND n.i = f.i + 1, LATERAL (SELECT f.shut OR n.label <> f.label OR n.a - f.b > 1.2 OR f.b - f.sa >= 12.0 OR f.c >= 35 AS z))
  SELECT conv_id, min(a) AS t0, max(b) AS t1, label AS speaker, count(*)::INTEGER AS words, string_agg(word, ' ' ORDER BY i) AS text FROM f GROUP BY conv_id, s, label""")
def word_segments(spark, d):
    words = utterances(spark, d).select("conv_id", "idx", F.col("label").alias("speaker"), F.col("t0").alias("at"), F.posexplode(F.split(text.clean_text(F.col("text")), " ")).alias("k", "word"))
    words = words.select("conv_id", "speaker", "word", (F.col("idx") * 1_000_000 + F.col("k")).alias("idx"), (F.col("at") / 1000 + F.col("k") * 0.3).alias("t0"), (F.col("at") / 1000 + F.col("k") * 0.3 + 0.25).alias("t1"))
    return sequence.fold_words(words, "conv_id")


# Intervals

CLICKS = f"""{SECONDS}, rows_ AS (SELECT user_id, event_id AS idx, sec AS t0, sec + 1800 * (1 + CAST(floor(value) AS BIGINT) % 24) AS t1 FROM e WHERE event_type = 'view'),
  turns AS (SELECT user_id, event_id AS ord, sec AS s, sec + 1800 * (1 + CAST(floor(value) AS BIGINT) % 24) AS f, 'c' || event_id AS label FROM e WHERE event_type = 'click'),
  hit AS (SELECT r.user_id, r.idx, t.label, row_number() OVER (PARTITION BY r.user_id, r.idx ORDER BY least(t1, f) - greatest(t0, s) DESC, f - s DESC, ord) AS n
    FROM rows_ r JOIN turns t ON r.user_id = t.user_id AND t0 < f AND t1 > s)"""


def _view_and_click(spark, d):
    e = seconds(spark, d).withColumn("stop", F.col("sec") + 1800 * (1 + F.floor("value") % 24))
    rows = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("idx"), F.col("sec").alias("t0"), F.col("stop").cast("double").alias("t1"))
    turns = e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("ord"), F.col("sec").alias("start"), F.col("stop").cast("double").alias("end"), F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("label"))
    return rows, turns


@query(f"""WITH {CLICKS}, best AS (SELECT user_id, idx, label FROM hit WHERE n = 1),
  near AS (SELECT r.user_id, r.idx, t.label, row_number() OVER (PARTITION BY r.user_id, r.idx ORDER BY abs((t0 + t1) / 2 - (s + f) / 2), ord) AS n
    FROM rows_ r JOIN turns t ON r.user_id = t.user_id WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.user_id = r.user_id AND b.idx = r.idx))
  SELECT r.user_id, r.idx, coalesce(b.label, n.label) AS label FROM rows_ r LEFT JOIN best b USING (user_id, idx) LEFT JOIN (SELECT * FROM near WHERE n = 1) n USING (user_id, idx)""")
def interval_max_overlap(spark, d):
    rows, turns = _view_and_click(spark, d)
    return intervals.assign_labels(rows, turns, "user_id", width=7200.0).select("user_id", "idx", "label")


@query(f"""WITH {SECONDS} SELECT c.user_id, c.event_id AS span, count(p.event_id) AS n, coalesce(string_agg(CAST(p.event_id AS VARCHAR), ',' ORDER BY p.sec, p.event_id), '') AS points
  FROM e c LEFT JOIN e p ON p.user_id = c.user_id AND p.event_type = 'view' AND c.sec <= p.sec AND p.sec < c.sec + 86400 WHERE c.event_type = 'purchase' GROUP BY ALL""")
def containment_nest(spark, d):
    e = seconds(spark, d)
    spans = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("span"), F.col("sec").alias("start"), (F.col("sec") + 86400).alias("end"))
    points = e.filter("event_type = 'view'").select("user_id", F.col("sec").alias("t"), "event_id")
    out = intervals.contain(spans, points, "user_id", ["event_id"], width=21600.0)
    some = F.coalesce(F.transform("points", lambda p: p["event_id"]), F.array().cast("array<bigint>"))
    return out.select("user_id", "span", F.size(some).cast("long").alias("n"), joined(some).alias("points"))


@query("""WITH o(ord, low, high, value) AS (VALUES (1, 0, 1, 'A'), (2, 1, 3, 'B'), (3, 5, 90, 'C')), h AS (SELECT conv_id, turn, arg_max(value, ord) AS v FROM conversations JOIN o ON turn BETWEEN low AND high GROUP BY ALL)
  SELECT conv_id, turn AS idx, coalesce(v, role) AS speaker FROM conversations LEFT JOIN h USING (conv_id, turn)""")
def range_override(spark, d):
    rows = utterances(spark, d)
    ranges = spark.createDataFrame([(1, 0, 1, "A"), (2, 1, 3, "B"), (3, 5, 90, "C")], "ord int, low long, high long, value string")
    own = rows.select("conv_id").distinct().crossJoin(F.broadcast(ranges))  # three constant rows
    out = intervals.override_ranges(rows, own, "conv_id")
    return out.select("conv_id", "idx", F.coalesce("value", "label").alias("speaker"))


@query(f"""WITH {SECONDS} SELECT a.event_id AS event, min(b.event_id) AS candidate FROM e a JOIN e b ON a.user_id = b.user_id AND abs(a.sec - b.sec) <= 9000
  WHERE a.event_type = 'signup' AND b.event_type = 'purchase' GROUP BY a.event_id""")
def tolerance_first_match(spark, d):
    e = seconds(spark, d)
    events = e.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("event"), F.col("sec").alias("t"))
    other = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("candidate"), F.col("sec").alias("t"))
    return intervals.first_within(events, other, "user_id", 9000.0)


@query(f"""WITH {SECONDS}, w AS (SELECT user_id, event_type, sec, event_id, lead(event_type) OVER p AS k, lead(sec) OVER p AS nx, max(sec) OVER (PARTITION BY user_id) AS last FROM e WHERE event_type IN ('signup', 'purchase')
   WINDOW p AS (PARTITION BY user_id ORDER BY sec, CASE event_type WHEN 'signup' THEN 'start' ELSE 'end' END))
  SELECT user_id, sec AS start, coalesce(nx, last) AS end FROM w WHERE event_type = 'signup'""")
def marker_pairs(spark, d):
    e = seconds(spark, d).filter(F.col("event_type").isin("signup", "purchase"))
    rows = e.select("user_id", "sec", F.when(F.col("event_type") == "signup", "start").otherwise("end").alias("kind"), F.max("sec").over(W.partitionBy("user_id")).alias("last"))
    return sequence.pair_markers(rows, "user_id", "kind", "sec", "last")


@query(f"""WITH {SECONDS}, g AS (SELECT user_id, (sec + lead(sec) OVER (PARTITION BY user_id ORDER BY sec, event_id)) / 2 AS mid, (min(sec) OVER (PARTITION BY user_id) + max(sec) OVER (PARTITION BY user_id)) / 2 AS target FROM e)
  SELECT user_id, arg_min(mid, abs(mid - target) * 1e9 + mid / 1e9) AS split FROM g WHERE mid IS NOT NULL GROUP BY user_id""")
def silence_split(spark, d):
    return sequence.silence_split(seconds(spark, d), "user_id", "sec", ["sec", "event_id"])


@query(f"""WITH {SECONDS}, c AS (SELECT user_id, event_id AS idx, CASE WHEN value > 20 THEN 'VOTE' ELSE 'REMARKS' END AS kind, sec AS start, sec + 172800 AS stop FROM e WHERE event_type = 'purchase'),
  i AS (SELECT c.user_id, idx, t.sec AS t, stop, count(*) OVER (PARTITION BY c.user_id, idx) AS n, lead(t.sec) OVER (PARTITION BY c.user_id, idx ORDER BY t.sec) AS nx
    FROM c JOIN e t ON t.user_id = c.user_id AND t.event_type = 'error' AND t.sec >= start - 3 AND t.sec < stop WHERE kind = 'VOTE'),
  p AS (SELECT user_id, idx, 'VOICE_VOTE' AS kind, t AS start, greatest(t + 1, coalesce(nx, stop)) AS end FROM i WHERE n >= 2)
  SELECT user_id, idx, kind, start, stop AS end FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = c.user_id AND p.idx = c.idx) UNION ALL SELECT * FROM p""")
def vote_split(spark, d):
    e = seconds(spark, d)
    chapters = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("idx"), F.when(F.col("value") > 20, "VOTE").otherwise("REMARKS").alias("kind"), F.col("sec").alias("start"), (F.col("sec") + 172800).alias("end"))
    return sequence.split_votes(chapters, e.filter("event_type = 'error'").select("user_id", F.col("sec").alias("t")), "user_id")


# Labels and names


@query("""SELECT coalesce(m.name, 'UNKNOWN') AS speaker, coalesce(m.c, 0.35) AS confidence, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS total FROM lineitem
  LEFT JOIN (VALUES ('R', 'Returned', 0.9), ('A', 'Accepted', 0.65)) m(label, name, c) ON l_returnflag = m.label GROUP BY ALL""")
def label_join_unknown(spark, d):
    known = spark.createDataFrame([("R", "Returned", 0.9), ("A", "Accepted", 0.65)], "label string, name string, c double")
    rows = sequence.named_labels(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("label"), "l_linenumber"), known, "label")
    return rows.groupBy("speaker", "confidence").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("total"))


_CODE = "rpad(upper(t[1:1]) || replace({0}[2:], '0', ''), 4, '0')"
_RUNS = "regexp_replace(translate(t, 'bfpvcgjkqsxzdtlmnraehiouwy', '11112222222233455600000000'), '00+', '0', 'g')"
for _digit in "123456":
    _RUNS = f"regexp_replace({_RUNS}, '{_digit}{_digit}+', '{_digit}', 'g')"
SOUND = f"rpad(upper(t[1:1]) || replace(({_RUNS})[2:], '0', ''), 4, '0')"


@query(f"WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS t FROM part) SELECT t AS word, {SOUND} AS code FROM w")
def soundex_variant(spark, d):
    words = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return words.select("word", text.sound_code(F.col("word")).alias("code"))


NAME_PAIRS = f"""c AS (SELECT DISTINCT x AS name, string_split(x, ' ') AS a FROM (SELECT p_name AS x FROM part UNION ALL SELECT replace(replace(p_name, 'll', 'l'), 'zm', 'smm') FROM part)),
  n AS (SELECT DISTINCT p_name AS anchor, string_split(p_name, ' ') AS b FROM part),
  s AS (SELECT t, {SOUND} AS code FROM (SELECT DISTINCT unnest(a) AS t FROM c)),
  d AS (SELECT x.t AS l, y.t AS r, CASE WHEN levenshtein(x.t, y.t) <= 2 THEN levenshtein(x.t, y.t) WHEN length(x.t) > 2 AND length(y.t) > 2 AND x.code = y.code THEN 2 END AS z FROM s x CROSS JOIN s y)"""


@query(f"""WITH {NAME_PAIRS}, sc AS (SELECT name, anchor, d1.z + d2.z AS score FROM c CROSS JOIN n JOIN d d1 ON d1.l = a[1] AND d1.r = b[1] JOIN d d2 ON d2.l = a[2] AND d2.r = b[2]),
  m AS (SELECT name, min(score) AS score FROM sc GROUP BY name)
  SELECT name, min(anchor) AS anchor, CAST(score AS INTEGER) AS score FROM sc JOIN m USING (name, score) GROUP BY name, score HAVING count(*) = 1""")
def fuzzy_name_snap(spark, d):
    names = table(spark, d, "part").select(F.col("p_name").alias("name"))
    odd = names.select(F.replace(F.replace("name", F.lit("ll"), F.lit("l")), F.lit("zm"), F.lit("smm")).alias("name"))
    return fuzzy.snap(names.unionByName(odd), names.withColumnRenamed("name", "anchor"))


@query("""WITH n AS (SELECT n_name AS anchor, lower(replace(n_name, '_', ' ')) AS b FROM nation), c AS (SELECT DISTINCT 'nation ' || (n_nationkey * 7 % 40) AS name FROM nation),
  t AS (SELECT x AS w, list_filter(string_split(x, ' '), lambda y: length(y) > 1) AS ts FROM (SELECT b AS x FROM n UNION SELECT name FROM c)),
  sc AS (SELECT name, anchor, y.ts AS bt, CASE WHEN x.ts = y.ts THEN 0
     WHEN len(x.ts) = len(y.ts) AND len(x.ts) = 2 AND levenshtein(x.ts[2], y.ts[2]) <= 2 THEN levenshtein(x.ts[2], y.ts[2]) END AS score
    FROM c CROSS JOIN n JOIN t x ON x.w = name JOIN t y ON y.w = b),
  m AS (SELECT name, min(score) AS score FROM sc WHERE score IS NOT NULL GROUP BY name)
  SELECT name, arg_min(anchor, length(anchor) * 1000000 + ascii(anchor[-1:]) + ascii(anchor[-2:-2]) * 300) AS anchor, CAST(score AS INTEGER) AS score FROM sc JOIN m USING (name, score) GROUP BY name, score HAVING count(DISTINCT bt) = 1""")
def org_fuzzy(spark, d):
    nations = table(spark, d, "nation")
    names = nations.select(F.concat(F.lit("nation "), (F.col("n_nationkey") * 7 % 40).cast("string")).alias("name"))
    return fuzzy.snap(names, nations.select(F.col("n_name").alias("anchor")), fuzzy.org_score)


@query("""SELECT conv_id, role AS speaker, 'v' || lpad(CAST(row_number() OVER (PARTITION BY conv_id ORDER BY min(turn)) AS VARCHAR), 3, '0') AS id, min(turn) AS first_index, count(*) AS n,
   coalesce(arg_max(left(text, 40), turn) FILTER (text ILIKE '%and%'), arg_min(left(text, 40), turn)) AS snippet FROM conversations WHERE role <> 'system' GROUP BY conv_id, role""")
def verification_candidates(spark, d):
    known = spark.createDataFrame([("system",)], "label string")
    rows = utterances(spark, d).withColumn("cut", F.substring("text", 1, 40))
    return sequence.verification_candidates(rows, known, "conv_id", "label", "cut", F.lower("text").contains("and"))


@query("""SELECT user_id, string_agg(event_type || ':' || n, ' ' ORDER BY r) AS top FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS r
   FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL)) WHERE r <= 3 GROUP BY user_id""")
def top3_histogram(spark, d):
    n = sequence.top_values(table(spark, d, "events"), "user_id", "event_type", "event_id")
    cells = F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(":", "event_type", "n").alias("c"))))
    return n.groupBy("user_id").agg(F.array_join(F.transform(cells, lambda x: x["c"]), " ").alias("top"))


# Registry


def _orders(spark, d):
    """orders as a registry: of status F all stages are done, of P the first; attempts by a rule of the key."""
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_totalprice").alias("cost_usd"),
        F.when(F.col("o_orderstatus") != "O", "fetched").otherwise("pending").alias("fetch_status"), F.when(F.col("o_orderstatus") == "F", "chapterized").otherwise("stubbed").alias("chapterize_status"),
        F.pmod(F.col("o_orderkey") * 7, F.lit(9)).alias("process_attempts"), "o_orderpriority",
    )


REGISTRY = """reg AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice AS cost_usd, CASE WHEN o_orderstatus <> 'O' THEN 'fetched' ELSE 'pending' END AS fetch_status,
  CASE WHEN o_orderstatus = 'F' THEN 'chapterized' ELSE 'stubbed' END AS chapterize_status, o_orderkey * 7 % 9 AS process_attempts, o_orderpriority FROM orders)"""


@query(f"WITH {REGISTRY} SELECT '{{\"key\":' || o_orderkey || ',\"day\":\"' || day || '\"}}' AS item FROM reg WHERE process_attempts < 5 AND day >= '1998-01-01' AND (fetch_status <> 'fetched' OR chapterize_status <> 'chapterized')")
def pending_matrix(spark, d):
    rows = registry.pending(_orders(spark, d), "1998-01-01", ["fetch_status", "chapterize_status"], F.col("day"))
    return registry.matrix_json(rows.withColumnRenamed("o_orderkey", "key"), "key", "day")


@query(f"WITH {REGISTRY} SELECT o_orderkey, day FROM reg WHERE fetch_status = 'fetched' AND chapterize_status <> 'chapterized' ORDER BY day, o_orderkey LIMIT 60")
def stage_candidates(spark, d):
    rows = registry.candidates(_orders(spark, d), "fetch_status", "chapterize_status", [F.col("day"), F.col("o_orderkey")], 60)
    return rows.select("o_orderkey", "day")


@query(f"WITH {REGISTRY} SELECT o_orderkey, c_name FROM reg LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 WHERE fetch_status = 'fetched' AND chapterize_status = 'chapterized' AND c_name <> ''")
def publishable(spark, d):
    c = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return registry.publishable(_orders(spark, d).join(c, "o_custkey", "left"), ["fetch_status", "chapterize_status"], "c_name").select("o_orderkey", "c_name")


@query(f"""WITH {REGISTRY} SELECT count(*) FILTER (process_attempts >= 5 AND chapterize_status <> 'chapterized') AS parked, max(day) AS newest, count(*) FILTER (fetch_status <> 'fetched' AND day < '1996-01-01') AS stale,
  (SELECT count(*) FROM events WHERE event_type = 'error' AND trim(props) <> '') AS errors FROM reg""")
def ci_health(spark, d):
    rows = _orders(spark, d).withColumn("is_parked", (F.col("process_attempts") >= registry.MAX_ATTEMPTS) & ~registry.done("chapterize_status"))
    errors = table(spark, d, "events").filter("event_type = 'error' and trim(props) <> ''").agg(F.count("*").alias("errors"))
    out = rows.agg(F.count_if("is_parked").alias("parked"), F.max("day").alias("newest"), F.count_if(~registry.done("fetch_status") & (F.col("day") < "1996-01-01")).alias("stale"))
    return out.join(F.broadcast(errors))


@query(f"""WITH {REGISTRY}, f AS (SELECT o_orderkey + 3 AS k, fetch_status AS fs, chapterize_status AS cs, CASE WHEN process_attempts = 8 THEN NULL ELSE process_attempts END AS pa, CASE WHEN o_custkey % 2 = 0 THEN cost_usd END AS cu, o_orderpriority AS pr FROM reg WHERE o_orderkey % 3 <> 1)
  SELECT o_orderkey, CASE WHEN k IS NULL THEN o_orderpriority ELSE pr END AS o_orderpriority, CASE WHEN k IS NULL OR (fetch_status = 'fetched' AND fs <> 'fetched') THEN fetch_status ELSE fs END AS fetch_status,
    CASE WHEN k IS NULL OR (chapterize_status = 'chapterized' AND cs <> 'chapterized') THEN chapterize_status ELSE cs END AS chapterize_status,
    CASE WHEN pa IS NULL THEN process_attempts WHEN pa = 0 THEN 0 ELSE greatest(pa, process_attempts) END AS process_attempts, coalesce(cu, cost_usd) AS cost_usd FROM reg LEFT JOIN f ON k = o_orderkey""")
def monotone_merge(spark, d):
    reg = _orders(spark, d).select("o_orderkey", "o_orderpriority", "fetch_status", "chapterize_status", "process_attempts", "cost_usd", "o_custkey")
    feed = reg.filter("o_orderkey % 3 <> 1").withColumns({
        "o_orderkey": F.col("o_orderkey") + 3, "ord": F.lit(1), "process_attempts": F.when(F.col("process_attempts") != 8, F.col("process_attempts")), "cost_usd": F.when(F.col("o_custkey") % 2 == 0, F.col("cost_usd")),
    })
    return registry.merge_results(reg.drop("o_custkey"), feed.drop("o_custkey"), "o_orderkey", ["fetch_status", "chapterize_status"], "process_attempts", "cost_usd")


@query("""SELECT coalesce(s.k, c.c_custkey) AS id, coalesce(s.name, c.c_name) AS name, coalesce(c.c_nationkey, s.nation) AS nation, coalesce(s.bal, c.c_acctbal) AS balance
  FROM customer c FULL JOIN (SELECT s_suppkey * 2 AS k, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name, s_nationkey AS nation, s_acctbal AS bal FROM supplier) s ON s.k = c.c_custkey""")
def identity_merge(spark, d):
    target = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    source = table(spark, d, "supplier").select((F.col("s_suppkey") * 2).alias("id"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return registry.upsert(target, source, "id", sticky=("nation",))


@query("""WITH a AS (SELECT c_custkey, c_name, c_nationkey * 3 AS other FROM customer), i AS (SELECT s_suppkey, s_suppkey * 5 AS first_, s_nationkey * 3 AS second_ FROM supplier)
  SELECT i.s_suppkey, coalesce(x.c_name, y.c_name) AS found, coalesce(x.c_name <> y.c_name, false) AS conflict FROM i LEFT JOIN (SELECT c_custkey, c_name FROM customer) x ON x.c_custkey = i.first_
  LEFT JOIN (SELECT c_nationkey * 3 AS k, min(c_name) AS c_name FROM customer GROUP BY 1) y ON y.k = i.second_""")
def dual_key_identity(spark, d):
    c = table(spark, d, "customer")
    first = c.select(F.col("c_custkey").alias("first"), F.lit(None).cast("int").alias("second"), F.col("c_name").alias("key"))
    second = c.groupBy((F.col("c_nationkey") * 3).alias("second")).agg(F.min("c_name").alias("key")).withColumn("first", F.lit(None).cast("long"))
    incoming = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 5).alias("first"), (F.col("s_nationkey") * 3).alias("second"))
    return registry.identify(incoming, first.unionByName(second), "first", "second", "key").select("s_suppkey", "found", "conflict")


@query("""WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'chapterized' WHEN 'P' THEN 'failed' ELSE 'stubbed' END AS status, o_totalprice AS price FROM orders),
  p AS (SELECT x.o_orderkey AS ka, y.o_orderkey AS kb, x.status = 'chapterized' AND y.status = 'stubbed' AS keep, x.status AS a, y.status AS b, CASE WHEN ka % 2 = 0 THEN x.price END AS pa, CASE WHEN kb % 3 > 0 THEN y.price END AS pb FROM o x JOIN o y ON y.o_orderkey = x.o_orderkey + 1)
  SELECT keep AS kept_event_row, CASE WHEN keep THEN ka ELSE kb END AS o_orderkey, CASE WHEN keep THEN kb ELSE ka END AS deleted, CASE WHEN keep THEN a WHEN b = 'chapterized' THEN b ELSE a END AS chapterize_status,
    CASE WHEN keep THEN coalesce(pa, pb) ELSE coalesce(pb, pa) END AS price FROM p""")
def conflict_merge(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "chapterized").when(F.col("o_orderstatus") == "P", "failed").otherwise("stubbed")
    o = table(spark, d, "orders").select("o_orderkey", status.alias("chapterize_status"), F.col("o_totalprice").alias("price"))
    a = o.withColumn("k", F.col("o_orderkey")).withColumn("price", F.when(F.col("k") % 2 == 0, F.col("price")))
    b = o.withColumn("k", F.col("o_orderkey") - 1).withColumn("price", F.when(F.col("o_orderkey") % 3 > 0, F.col("price")))
    pairs = a.alias("a").join(b.alias("b"), F.col("a.k") == F.col("b.k"))
    return registry.resolve_conflicts(pairs, ["chapterize_status"], ["o_orderkey", "chapterize_status", "price"], "o_orderkey")


@query("""WITH RECURSIVE o AS (SELECT o_orderkey AS k, o_orderkey % 4 AS m, o_totalprice AS cost, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE o_orderstatus WHEN 'F' THEN 'chapterized' WHEN 'P' THEN 'failed' ELSE 'stubbed' END AS st, o_orderpriority AS pr FROM orders WHERE o_custkey % 10 <> 0),
  reg AS (SELECT 'r' || k AS meeting_key, CASE WHEN m = 0 THEN k END AS event, CASE WHEN m = 1 THEN 'f' || k // 4 END AS file, day, cost, st FROM o WHERE m IN (0, 1)),
  feed AS (SELECT k * 2 AS ord, k // 4 * 4 AS event, 'f' || k // 4 AS file, pr AS body, CASE WHEN k % 8 = 2 THEN day END AS day FROM o WHERE m = 2
    UNION ALL SELECT k * 2 + 1, CASE WHEN k % 8 = 3 THEN k // 4 * 4 END, CASE WHEN k % 8 <> 3 THEN 'f' || k // 4 END, pr, NULL FROM o WHERE m = 3),
  steps AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ord) AS n FROM (SELECT *, coalesce(event // 4, CAST(substr(file, 2) AS BIGINT)) AS file_id FROM feed)),
  start AS (SELECT g.id, list(struct_pack(meeting_key, event, file, day, cost, st, body := CAST(NULL AS VARCHAR)) ORDER BY meeting_key) FILTER (meeting_key IS NOT NULL) AS t
    FROM (SELECT DISTINCT k // 4 AS id FROM o) g LEFT JOIN reg ON g.id = coalesce(event // 4, CAST(substr(file, 2) AS BIGINT)) GROUP BY g.id),
  fold(id, n, t) AS (
    SELECT id, 0, coalesce(t, []) FROM start
    UNION ALL
    SELECT id, s.n, CASE
        WHEN a IS NOT NULL AND b IS NOT NULL AND a.meeting_key <> b.meeting_key AND a.st = 'chapterized' AND b.st = 'stubbed'
          THEN [struct_pack(meeting_key := a.meeting_key, event := coalesce(s.event, a.event), file := coalesce(s.file, b.file), day := coalesce(s.day, a.day, b.day), cost := coalesce(a.cost, b.cost), st := a.st, body := s.body)]
        WHEN a IS NOT NULL AND b IS NOT NULL AND a.meeting_key <> b.meeting_key
          THEN [struct_pack(meeting_key := b.meeting_key, event := coalesce(s.event, b.event), file := coalesce(s.file, b.file), day := coalesce(s.day, b.day, a.day), cost := coalesce(b.cost, a.cost), st := CASE WHEN b.st = 'chapterized' THEN b.st ELSE a.st END, body := s.body)]
        WHEN a IS NULL AND b IS NULL
          THEN list_append(t, struct_pack(meeting_key := coalesce(s.file, 'event-' || s.event), event := s.event, file := s.file, day := s.day, cost := NULL, st := 'stubbed', body := s.body))
        ELSE list_transform(t, lambda x: CASE WHEN x.meeting_key = coalesce(a.meeting_key, b.meeting_key)
          THEN struct_pack(meeting_key := x.meeting_key, event := coalesce(s.event, x.event), file := coalesce(s.file, x.file), day := coalesce(s.day, x.day), cost := x.cost, st := x.st, body := s.body) ELSE x END) END
    FROM (SELECT f.id, f.t, s, list_filter(f.t, lambda x: x.event = s.event)[1] AS a, list_filter(f.t, lambda x: x.file = s.file)[1] AS b FROM fold f JOIN steps s ON s.file_id = f.id AND s.n = f.n + 1)),
  last AS (SELECT id, arg_max(t, n) AS t FROM fold GROUP BY id)
  SELECT x.meeting_key AS meeting_key, x.event AS legistar_event_id, x.file AS viebit_filename, x.day AS event_date, x.cost AS cost_usd, x.st AS chapterize_status, x.body AS body_name FROM (SELECT unnest(t) AS x FROM last)""")
def batch_upsert(spark, d):
    """Of each four orders the first is a row known by its event, the second one known by its recording, the third
    says that both are one, and the fourth brings news by one of the two identifiers; some of the four are missing."""
    o = table(spark, d, "orders").filter("o_custkey % 10 <> 0").withColumn("g", F.floor(F.col("o_orderkey") / 4).cast("long")).withColumn("m", F.col("o_orderkey") % 4)
    file, event, day = F.concat(F.lit("f"), F.col("g").cast("string")), F.col("g") * 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.when(F.col("o_orderstatus") == "F", "chapterized").when(F.col("o_orderstatus") == "P", "failed").otherwise("stubbed")
    held = o.filter("m < 2").select(
        F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("meeting_key"), F.when(F.col("m") == 0, event).alias("legistar_event_id"), F.when(F.col("m") == 1, file).alias("viebit_filename"),
        day.alias("event_date"), F.col("o_totalprice").alias("cost_usd"), status.alias("chapterize_status"), F.lit(None).cast("string").alias("body_name"),
    )
    link, by_event = F.col("m") == 2, F.col("o_orderkey") % 8 == 3
    feed = o.filter("m > 1").select(
        F.col("o_orderkey").alias("ord"), F.when(link | by_event, event).alias("legistar_event_id"), F.when(link | ~by_event, file).alias("viebit_filename"),
        F.col("o_orderpriority").alias("body_name"), F.when(F.col("o_orderkey") % 8 == 2, day).alias("event_date"),
    )
    return registry.upsert_batch(held, feed, "2025-05-01T00:00:00Z")


@query("""WITH r AS (SELECT l_orderkey, max(l_linestatus) AS status FROM lineitem WHERE l_linenumber < 3 GROUP BY l_orderkey)
  SELECT o_orderkey, status, CASE WHEN status IS NULL THEN 'missing' ELSE 'bad status' END AS problem FROM orders LEFT JOIN r ON o_orderkey = l_orderkey WHERE status IS NULL OR status NOT IN ('F')""")
def missing_results(spark, d):
    got = table(spark, d, "lineitem").filter("l_linenumber < 3").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("status"))
    return registry.missing_results(table(spark, d, "orders"), got, "o_orderkey", ("F",))


@query(f"WITH {REGISTRY} SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 'stubbed' ELSE chapterize_status END AS chapterize_status, CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE process_attempts END AS process_attempts FROM reg")
def reset_state(spark, d):
    rows = _orders(spark, d).withColumn("last_error", F.lit("x"))
    return registry.reset(rows, F.col("o_custkey") % 5 == 0, ["chapterize_status"], "process_attempts", "last_error").select("o_orderkey", "chapterize_status", F.col("process_attempts").cast("long").alias("process_attempts"))


@query(f"WITH {REGISTRY} SELECT o_orderkey, CASE WHEN fetch_status = 'fetched' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 10) THEN 'pending' ELSE fetch_status END AS fetch_status FROM reg")
def reconcile_artifacts(spark, d):
    files = table(spark, d, "lineitem").filter("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    return registry.downgrade(_orders(spark, d).select("o_orderkey", "fetch_status"), files, "o_orderkey", "fetch_status")


@query(f"WITH {REGISTRY}, l AS (SELECT l_orderkey, min(l_shipdate) AS m FROM lineitem WHERE l_tax > 0.07 GROUP BY 1) SELECT o_orderkey, process_attempts + CASE WHEN m IS NULL THEN 0 ELSE 1 END AS process_attempts, 'late ' || strftime(m, '%Y-%m-%d') AS last_error FROM reg LEFT JOIN l ON l_orderkey = o_orderkey")
def record_failures(spark, d):
    failed = table(spark, d, "lineitem").filter("l_tax > 0.07").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.concat(F.lit("late "), F.date_format(F.min("l_shipdate"), "yyyy-MM-dd")).alias("message"))
    rows = _orders(spark, d).withColumn("last_error", F.lit(None).cast("string"))
    return registry.record_failure(rows, failed, "o_orderkey", "process_attempts", "last_error").select("o_orderkey", "process_attempts", "last_error")


@query("SELECT o_orderkey FROM orders WHERE DATE '1998-06-01' BETWEEN CAST(o_orderdate AS DATE) AND CASE WHEN o_custkey % 4 = 0 THEN DATE '0001-01-01' ELSE CAST(o_orderdate AS DATE) + 90 END")
def roster_temporal(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("term_start"), F.when(F.col("o_custkey") % 4 > 0, F.date_add(F.col("o_orderdate").cast("date"), 90)).alias("term_end"))
    return registry.in_term(rows, "term_start", "term_end", F.lit("1998-06-01").cast("date")).select("o_orderkey")


@query("""WITH a AS (SELECT DISTINCT upper(source) AS term, 1 AS p FROM documents UNION ALL SELECT DISTINCT lang, 0 FROM documents UNION ALL SELECT DISTINCT source || '-' || lang, 2 FROM documents WHERE n_chars > 3000 UNION ALL SELECT DISTINCT source, 3 FROM documents)
  SELECT CAST(p AS INTEGER) AS priority, count(*) AS n, min(term) AS first FROM (SELECT *, row_number() OVER (PARTITION BY lower(term) ORDER BY p, term) AS r FROM a) WHERE r = 1 GROUP BY p""")
def priority_dedupe(spark, d):
    docs = table(spark, d, "documents")
    lists = [docs.select(F.col("lang").alias("term")), docs.select(F.upper("source").alias("term")), docs.filter("n_chars > 3000").select(F.concat_ws("-", "source", "lang").alias("term")), docs.select(F.col("source").alias("term"))]
    kept = registry.union_by_priority([x.distinct() for x in lists], "term", ["term"])
    return kept.groupBy("priority").agg(F.count("*").alias("n"), F.min("term").alias("first"))


@query("""SELECT slug, src FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY src, id) AS r FROM (SELECT 0 AS src, s_suppkey AS id, 'n' || s_suppkey AS slug FROM supplier UNION ALL SELECT 1, c_custkey, 'n' || c_custkey // 2 FROM customer)) WHERE r = 1""")
def union_first_wins(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("n"), F.col("s_suppkey").cast("string")).alias("slug"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("n"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("slug"))
    return registry.union_by_priority([s, c], "slug", ["id"]).select("slug", F.col("priority").alias("src"))


@query("""SELECT doc_id FROM documents WHERE doc_id % 4 = 0 OR (doc_id % 4 = 1 AND lower(text) <> text) OR (doc_id % 4 = 2 AND source <> '')""")
def content_change_filter(spark, d):
    new = table(spark, d, "documents").select("doc_id", "text", "source")
    old = new.filter("doc_id % 4 <> 0").withColumns({"text": F.when(F.col("doc_id") % 4 == 1, F.lower("text")).otherwise(F.col("text")), "source": F.when(F.col("doc_id") % 4 != 2, F.col("source"))})
    return registry.changed(old, new, "doc_id", "text", "source").select("doc_id")


@query("""WITH a AS (SELECT o_orderdate, DATE_DIFF('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age, o_orderkey, 1 + o_orderkey % 7 AS n FROM orders),
  s AS (SELECT *, sum(n) OVER (ORDER BY age, o_orderkey) AS total FROM a WHERE age <= 90) SELECT o_orderkey, CAST(age AS INTEGER) AS age, n FROM s WHERE total <= 600""")
def recent_prefix_budget(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), (1 + F.col("o_orderkey") % 7).alias("n"))
    newest = o.agg(F.max("day").alias("newest"))
    rows = o.join(F.broadcast(newest)).withColumn("age", F.date_diff("newest", "day")).select("o_orderkey", "age", "n")
    return sequence.prefix_budget(rows, "n", "age", 600, 90, [F.col("o_orderkey")])


# Text, time and numbers


@query("SELECT p_partkey, CASE WHEN r = 1 THEN base ELSE base || '-' || r END AS unique_key FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS r FROM (SELECT p_partkey, trim(regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^a-z0-9]+', '-', 'g'), '-') AS base FROM part))")
def slug_dedupe(spark, d):
    rows = table(spark, d, "part").select("p_partkey", text.slug(F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")), 96).alias("base"))
    return sequence.number_repeats(rows, [], "base", ["p_partkey"]).select("p_partkey", "unique_key")


_REPAIR = "x"
for _ in range(11):
    for _pattern in (r"(\d)\s+\.(\d)", r"(?i)(\d)\.\s+(\d+\s*(?:%|(?:percent|billion|million|thousand|trillion|bn|mm?)\b))", r"(\d)\.\s+(\d+\.\d)"):
        _REPAIR = f"regexp_replace({_REPAIR}, '{_pattern}', '\\1.\\2', 'g')"


@query(f"SELECT p_partkey, trim(regexp_replace({_REPAIR}, '[ \\t]+', ' ', 'g')) AS repaired FROM (SELECT p_partkey, '$' || p_size || '. ' || p_partkey % 10 || '. 5 billion in 2012. ' || p_size || ' members, 12 .8 percent, 1. 2. 3. 4. 5. 6. 7. 8. 9. 5 billion' AS x FROM part)")
def decimal_repair(spark, d):
    p = F.col("p_size").cast("string")
    odd = F.concat(F.lit("$"), p, F.lit(". "), (F.col("p_partkey") % 10).cast("string"), F.lit(". 5 billion in 2012. "), p, F.lit(" members, 12 .8 percent, 1. 2. 3. 4. 5. 6. 7. 8. 9. 5 billion"))
    return table(spark, d, "part").select("p_partkey", text.repair_decimals(odd).alias("repaired"))


@query("SELECT page_id, length(t) AS n, md5(t) AS digest FROM (SELECT page_id, trim(regexp_replace(html, '\\s+', ' ', 'g')) AS t FROM pages)")
def clean_text(spark, d):
    rows = table(spark, d, "pages").select("page_id", text.clean_text(F.col("html")).alias("t"))
    return rows.select("page_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("digest"))


@query("SELECT event_id, printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS clock, s AS back FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) % 200000 AS s FROM events)")
def clock_format(spark, d):
    s = seconds(spark, d).select("event_id", (F.col("sec").cast("long") % 200000).alias("s"))
    s = s.withColumn("clock", timeparse.seconds_to_clock(F.col("s")))
    return s.select("event_id", "clock", timeparse.clock_to_seconds(F.col("clock")).cast("long").alias("back"))


@query("""WITH o AS (SELECT o_orderkey, o_orderdate, o_orderkey % 24 AS h, o_orderkey % 60 AS m FROM orders)
  SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) + CASE o_orderkey % 3 WHEN 2 THEN 0 ELSE h * 3600 + m * 60 END AS at,
    abs(CASE o_orderkey % 3 WHEN 2 THEN 0 ELSE h * 60 + m END - 600.0) AS minutes FROM o""")
def event_datetime_parse(spark, d):
    o = table(spark, d, "orders")
    h, m = F.col("o_orderkey") % 24, F.col("o_orderkey") % 60
    half = F.format_string("%d:%02d %s", F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12), m, F.when(h < 12, "AM").otherwise("PM"))
    time = F.when(F.col("o_orderkey") % 3 == 0, half).when(F.col("o_orderkey") % 3 == 1, F.format_string("%02d:%02d", h, m)).otherwise("to be announced")
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00")
    out = o.select("o_orderkey", timeparse.event_time(day, time).alias("t"), timeparse.event_time(day, F.lit("10:00 AM")).alias("ten"))
    return out.select("o_orderkey", F.unix_timestamp("t").alias("at"), timeparse.minutes_apart(F.col("t"), F.col("ten")).alias("minutes"))


@query("""SELECT doc_id, CASE quality + 2 * toxic WHEN 0 THEN 0.35 WHEN 1 THEN 0.9 WHEN 2 THEN 0.2 ELSE 0.5 END AS score FROM labels""")
def confidence_score(spark, d):
    words = F.element_at(F.array(F.lit("weak"), F.lit(" High "), F.lit("none"), F.lit("hm")), (F.col("quality") + 2 * F.col("toxic") + 1).cast("int"))
    return table(spark, d, "labels").select("doc_id", scalar.confidence(words).alias("score"))


@query("""SELECT page_id, len(l) AS n, array_to_string(list_transform(l, lambda x: x), ' ') AS links FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)""")
def html_links(spark, d):
    rows = table(spark, d, "pages").select("page_id", text.links(F.col("html")).alias("l"))
    return rows.select("page_id", F.size("l").cast("long").alias("n"), F.array_join("l", " ").alias("links"))


@query("SELECT page_id, url AS decoded FROM pages")
def base64_links(spark, d):
    rows = table(spark, d, "pages").select("page_id", F.url_encode(F.regexp_replace(F.base64(F.encode("url", "utf-8")), "[=\r\n]", "")).alias("coded"))
    return rows.select("page_id", text.base64_url(F.col("coded")).alias("decoded"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS first FROM events")
def json_props(spark, d):
    p = F.col("props")
    return table(spark, d, "events").select("event_id", scalar.json_object(p, "k long")["k"].alias("k"), scalar.json_first(p, "$.missing", "$.k").alias("first"))


@query("SELECT user_id, 'k' AS key, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY user_id")
def usage_map_sum(spark, d):
    rows = table(spark, d, "events").select("user_id", F.from_json("props", "map<string,bigint>").alias("usage"))
    return costs.sum_maps(rows, ["user_id"], "usage")


@query("""SELECT l_orderkey, CAST(sum(CAST(round(round(l_quantity * 60 / 3600 * CASE l_linestatus WHEN 'F' THEN 0.18::DOUBLE ELSE 0.09::DOUBLE END + l_tax, 6) * 1000000) AS BIGINT)) AS BIGINT) AS micro_usd, count(*) AS parts,
  CASE WHEN count(*) = count(CASE WHEN l_discount > 0.01 THEN 1 END) THEN CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) END AS all_or_null FROM lineitem GROUP BY l_orderkey""")
def meeting_cost(spark, d):
    li = table(spark, d, "lineitem")
    cost = costs.meeting_cost(F.col("l_quantity").cast("double") * 60, F.when(F.col("l_linestatus") == "F", "sync").otherwise("batch"), F.col("l_tax").cast("double"))
    some = F.when(F.col("l_discount") > 0.01, F.round(F.col("l_discount") * 100).cast("long"))
    return li.groupBy("l_orderkey").agg(F.sum(F.round(cost * 1_000_000).cast("long")).alias("micro_usd"), F.count("*").alias("parts"), costs.total_if_all(some).alias("all_or_null"))


@query("SELECT value, count(*) AS n FROM (SELECT unnest([lang, source, CASE WHEN n_chars > 3000 THEN 'LONG' ELSE 'SHORT' END]) AS value FROM documents) GROUP BY value")
def tag_facets(spark, d):
    size = F.when(F.col("n_chars") > 3000, "LONG").otherwise("SHORT")
    return documents.facets(table(spark, d, "documents").select(F.array("lang", "source", size).alias("tags")), "tags")


@query("SELECT label, n, row_number() OVER (ORDER BY n DESC, label COLLATE NOACCENT.NOCASE, label)::INTEGER AS place FROM (SELECT upper(event_type[1:1]) || event_type[2:] AS label, count(*) AS n FROM events GROUP BY 1)")
def type_facets(spark, d):
    return documents.label_facets(table(spark, d, "events"), "event_type")


@query("SELECT event_type AS value, count(*) AS n, count(DISTINCT user_id) AS who FROM events GROUP BY event_type")
def facets_of_parts(spark, d):
    """Facets kept by day and merged: counts, and how many users are behind a type."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), F.col("event_type").alias("value"), "user_id")
    return documents.merged_facets(documents.facet_parts(e, "day", "value", "user_id"), "value")


@query("""SELECT doc_id, CAST(k AS INTEGER) AS index, CAST((k - 1) * 1800 AS DOUBLE) AS offset, least(CAST(k * 1800 AS DOUBLE), n_chars) AS end, CASE WHEN k = 1 THEN '' ELSE '_part' || k END AS suffix
  FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, unnest(range(1, CAST(ceil((n_chars - 0.5) / 1800) AS BIGINT) + 1)) AS k FROM documents)""")
def fixed_parts(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.explode(sequence.fixed_parts(F.col("n_chars").cast("double"), 1800.0)).alias("p"))
    return rows.select("doc_id", "p.index", "p.offset", "p.end", "p.suffix")


@query("""SELECT doc_id, substr(sha256(text || chr(31) || lang), 1, 16) AS version, 'chapters/' || doc_id || '.' || substr(sha256(text || chr(31) || lang), 1, 16) || '.json' AS data_key FROM documents""")
def route_manifest(spark, d):
    return documents.with_version(table(spark, d, "documents"), "doc_id", "text", "lang").select("doc_id", "version", "data_key")


@query("""SELECT r_name, count(n_nationkey) AS n, string_agg(n_name || '(' || s || ')', ';' ORDER BY n_nationkey) AS nations FROM region JOIN (SELECT n_regionkey, n_nationkey, n_name,
   (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS s FROM nation) ON n_regionkey = r_regionkey GROUP BY r_name""")
def doc_nest(spark, d):
    suppliers = table(spark, d, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_name")
    nations = documents.nest(table(spark, d, "nation"), suppliers, "n_nationkey", ["s_suppkey"], ["s_suppkey", "s_name"], "suppliers")
    regions = documents.nest(table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), nations, "n_regionkey", ["n_nationkey"], ["n_nationkey", "n_name", "suppliers"], "nations")
    cell = F.transform("nations", lambda x: F.concat(x["n_name"], F.lit("("), F.size(x["suppliers"]).cast("string"), F.lit(")")))
    return regions.filter(F.size("nations") > 0).select("r_name", F.size("nations").cast("long").alias("n"), F.array_join(cell, ";").alias("nations"))


@query("""SELECT '/meetings/talk-' || conv_id % 7 || '/m' || conv_id || '/c' || turn AS path, 'm' || conv_id AS slug, CAST(turn AS INTEGER) AS chapter_index, CASE WHEN turn > 0 THEN 'c' || turn - 1 END AS previous,
   CASE WHEN turn < (SELECT max(turn) FROM conversations z WHERE z.conv_id = c.conv_id) THEN 'c' || turn + 1 END AS next FROM conversations c WHERE turn <= 1""")
def chapter_lookup(spark, d):
    """Addresses of each conversation's first two turns, as they are asked for, found in the manifest; with the neighbours."""
    slug = F.concat(F.lit("m"), F.col("conv_id").cast("string")).alias("slug")
    turns = table(spark, d, "conversations").select(slug, "turn", F.concat(F.lit("c"), F.col("turn").cast("string")).alias("chapter"))
    talks = table(spark, d, "conversations").select("conv_id").distinct().select(slug, F.concat(F.lit("Talk "), (F.col("conv_id") % 7).cast("string")).alias("body"), F.lit("2025-05-01").alias("date"))
    chapters = turns.select("slug", "turn", F.struct(F.col("chapter").alias("slug"), F.col("turn").cast("string").alias("id")).alias("chapter"))
    docs = documents.nest(talks, chapters, "slug", ["turn"], ["turn", "chapter"], "chapters").withColumn("chapters", F.transform("chapters", lambda x: x["chapter"]))
    head, tail = F.when(F.col("turn") == 0, "/og/chapter/").otherwise("/meetings/"), F.when(F.col("turn") == 0, ".png").otherwise("/")
    asked = F.concat(head, text.site_slug(F.col("body")), F.lit("/"), F.col("slug"), F.lit("/c"), F.col("turn").cast("string"), tail)
    paths = talks.withColumn("turn", F.explode(F.lit([0, 1]))).select(asked.alias("path"))
    near = documents.neighbours(turns, "slug", "turn", "chapter").select("slug", F.col("chapter").alias("chapter_slug"), "previous", "next")
    return documents.by_path(documents.routes(docs), paths).join(near, ["slug", "chapter_slug"]).select("path", "slug", "chapter_index", "previous", "next")


@query("""SELECT trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '-', 'g'), '-') AS body_slug, count(*) AS n, max(strftime(o_orderdate, '%Y-%m-%d')) AS newest FROM orders GROUP BY 1""")
def bodies(spark, d):
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderpriority")
    return documents.by_body(o, "o_orderpriority", ["date"]).select("body_slug", "n", F.get("meetings", F.lit(0))["date"].alias("newest"))


@query("SELECT key, count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT user_id, unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def schema_summary(spark, d):
    return documents.key_summary(table(spark, d, "events"), "props", "user_id").withColumnRenamed("n_user_id", "users")


@query("""SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS labels, count(DISTINCT event_type) AS n, max(CASE WHEN value > 0 THEN value ELSE 0 END) AS top FROM events GROUP BY user_id""")
def label_sets(spark, d):
    sets = documents.label_sets(table(spark, d, "events"), "user_id", "event_type", F.coalesce(F.nullif("value", F.lit(0.0)), F.lit(0.0)))
    return sets.select("user_id", F.array_join("labels", ",").alias("labels"), "n", F.col("most0").alias("top"))


@query("""SELECT p_partkey, CASE WHEN b = 'city council' OR t LIKE '%stated meeting%' THEN 'STATED_MEETING' WHEN regexp_matches(t, 'land use|zoning|franchises|landmarks|public siting') THEN 'LAND_USE' WHEN regexp_matches(t, 'vote|voting') THEN 'VOTE' ELSE 'HEARING' END AS kind
  FROM (SELECT p_partkey, lower(trim(x)) AS b, lower(x) || ' ' || lower(p_type) AS t FROM (SELECT *, CASE p_partkey % 5 WHEN 0 THEN 'City Council' WHEN 1 THEN 'Committee on Land Use' WHEN 2 THEN 'Voting Rights' WHEN 3 THEN 'Stated Meeting' ELSE p_name END AS x FROM part))""")
def meeting_types(spark, d):
    k = F.col("p_partkey") % 5
    body = F.when(k == 0, "City Council").when(k == 1, "Committee on Land Use").when(k == 2, "Voting Rights").when(k == 3, "Stated Meeting").otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", scalar.meeting_type_from_event(body, F.col("p_type")).alias("kind"))


@query("SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS cursor, count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_cursor(spark, d):
    """What a run after this cursor takes in, and the cursor it leaves."""
    start = "2024-01-15T00:00:00"
    fresh = table(spark, d, "events").filter("ts > timestamp_ntz'2024-01-15 00:00:00'").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("modified"))
    return fresh.agg(F.lit(incremental.next_cursor(fresh, "modified", start)).alias("cursor"), F.count("*").alias("n"))


@query("""SELECT time_bucket(INTERVAL '6 hours', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def tumbling_counts(spark, d):
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return incremental.windowed_counts(e, "ts", "event_type", "6 hours").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY CUBE (c_mktsegment, c_nationkey)")
def customer_cube(spark, d):
    return documents.cube_counts(table(spark, d, "customer"), "c_mktsegment", "c_nationkey")


# Terms, corrections, choices


@query("""WITH l(ord, k, terms) AS (VALUES (0, ['bolt', 'gear'], ['Works', 'Metal']), (1, ['red', 'ring'], ['Colour', 'metal'])), b AS (SELECT DISTINCT p_name AS body FROM part),
  t AS (SELECT body, ord, unnest(terms) AS t, generate_subscripts(terms, 1) AS i FROM b JOIN l ON len(list_filter(k, lambda x: contains(lower(body), x))) > 0 UNION ALL SELECT body, 9, 'City', 1 FROM b),
  f AS (SELECT *, row_number() OVER (PARTITION BY body, lower(t) ORDER BY ord, i) AS n FROM t) SELECT body, string_agg(t, ',' ORDER BY ord, i) AS terms FROM f WHERE n = 1 GROUP BY body""")
def keyword_terms(spark, d):
    lists = spark.createDataFrame([(["bolt", "gear"], ["Works", "Metal"]), (["red", "ring"], ["Colour", "metal"])], "keywords array<string>, terms array<string>").coalesce(1)
    out = terms.keyword_terms(table(spark, d, "part").select(F.col("p_name").alias("body")), lists, ["City"])
    return out.select("body", F.array_join("terms", ",").alias("terms"))


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 6 = 0 THEN 'fixed ' || c_custkey WHEN c_nationkey = 3 THEN 'third' ELSE c_mktsegment END AS speaker FROM customer""")
def speaker_corrections(spark, d):
    c = table(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("id"), F.concat_ws("|", F.when(F.col("c_nationkey") == 3, "N3"), F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment"))).alias("speaker"))
    by_id = c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("speaker"), F.concat(F.lit("fixed "), F.col("c_custkey").cast("string")).alias("corrected"), F.when(F.col("c_custkey") % 2 == 0, "high").otherwise("low").alias("confidence"), F.lit(1).alias("ord"))
    by_name = spark.createDataFrame([(None, "N3", "second", "high", 1), (None, "N3", "third", "high", 2)], "id long, speaker string, corrected string, confidence string, ord int")
    return terms.apply_corrections(rows, by_id.unionByName(by_name))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY abs(o_orderkey % 11 - 5), o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def best_of_retries(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.abs(F.col("o_orderkey") % 11 - 5).alias("distance"))
    return terms.better_candidate(o, "o_custkey", "distance", "o_orderkey").select("o_custkey", "o_orderkey")


@query("""SELECT o_orderkey AS custom_id, 'b' || l_linenumber AS body FROM orders JOIN (SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""")
def batch_outputs(spark, d):
    li = table(spark, d, "lineitem").filter("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("custom_id")).agg(F.min("l_linenumber").alias("n"))
    rows = li.select("custom_id", F.struct(F.lit(200).alias("status_code"), F.concat(F.lit("b"), F.col("n").cast("string")).alias("body")).alias("response"))
    bad = rows.withColumn("custom_id", F.col("custom_id") + 10_000_000).unionByName(rows.withColumn("response", F.struct(F.lit(500).alias("status_code"), F.lit("no").alias("body"))))
    parts = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("custom_id"))
    return terms.batch_results(rows.unionByName(bad), parts)


@query("""SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def ordered_text(spark, d):
    return terms.ordered_text(table(spark, d, "conversations"), ["conv_id"], "turn", "text", "\n")


@query("""SELECT o_orderkey AS meeting_key, o_custkey % 4 AS part, count(*) AS segments, count(DISTINCT l_returnflag) AS speakers, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS labels FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def part_counts(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 4).alias("part"))
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("label")).join(o, "l_orderkey")
    out = terms.part_counts(rows.withColumnRenamed("l_orderkey", "meeting_key"))
    return out.withColumn("labels", F.array_join("labels", ","))


@query("SELECT page_id, 'https://v.example/' || page_id || '/clip?u=' || length(url) AS link FROM pages")
def url_templates(spark, d):
    return table(spark, d, "pages").select("page_id", terms.address("https://v.example/{id}/clip?u={n}", id=F.col("page_id"), n=F.length("url")).alias("link"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, max(CASE WHEN l_quantity > 0 THEN l_quantity * 1500000 + l_linenumber * 3000000 END) AS micro FROM lineitem GROUP BY ALL""")
def token_costs(spark, d):
    paid = costs.token_cost(F.col("l_quantity"), F.col("l_linenumber"), F.lit(None).cast("int"), F.lit(0), 1_500_000.0, 3_000_000.0, 0.0) * 1_000_000
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.max(paid).alias("micro"))


# Functions and operators that need no table of their own


@query("""SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(p_name || ' (' || p_brand || ')', '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'meeting') AS key,
  coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, ''), p_name) AS present, regexp_replace(upper(trim(p_brand || ' - x')), '[\\s-]+', '_', 'g') AS token FROM part""")
def keys_and_tokens(spark, d):
    odd = F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_brand"))
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return table(spark, d, "part").select("p_partkey", text.safe_key(name).alias("key"), text.first_present(odd, F.col("p_name")).alias("present"), text.type_token(F.concat("p_brand", F.lit(" - x"))).alias("token"))


@query("""WITH s AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Council Member ' || c_name WHEN 1 THEN 'Member of the Public - Dr. ' || c_name WHEN 2 THEN ' unk ' ELSE 'Council Staff -  Mx ' || c_name END AS x FROM customer),
  c AS (SELECT *, trim(regexp_replace(replace(x, 'Council Member ', ''), '\\s+', ' ', 'g')) AS c,
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '^Member of the Public - ', ''), '^Council Staff - *', ''), '^(Dr|Mr|Ms|Mrs|Mx)[.]? +', ''), '\\s+', ' ', 'g')) AS b FROM s)
  SELECT c_custkey, CASE WHEN c = '' OR upper(c) IN ('UNKNOWN', 'UNK') THEN 'UNKNOWN' ELSE c END AS speaker, b AS base, array_to_string(regexp_extract_all(lower(b), '[a-z]+'), ' ') AS key FROM c""")
def speaker_names(spark, d):
    c = table(spark, d, "customer")
    kind = F.col("c_custkey") % 4
    x = F.when(kind == 0, F.concat(F.lit("Council Member "), "c_name")).when(kind == 1, F.concat(F.lit("Member of the Public - Dr. "), "c_name")).when(kind == 2, F.lit(" unk ")).otherwise(F.concat(F.lit("Council Staff -  Mx "), "c_name"))
    return c.select("c_custkey", text.clean_speaker(x).alias("speaker"), text.speaker_base_name(x).alias("base"), text.name_key(x).alias("key"))


@query("""WITH t AS (SELECT page_id, 'https://h/p/ROOM-' || (page_id % 7) || '_250423-10' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || '21.mp4?key=abc&x=1' AS u FROM pages)
  SELECT page_id, regexp_replace(u, 'key=[^&]*', 'key=[redacted]') AS safe, 'ROOM-' || (page_id % 7) || '_250423-10' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || '21' AS stem, 'ROOM-' || (page_id % 7) AS room FROM t""")
def recording_names(spark, d):
    minute = F.lpad((F.col("page_id") % 60).cast("string"), 2, "0")
    url = F.concat(F.lit("https://h/p/ROOM-"), (F.col("page_id") % 7).cast("string"), F.lit("_250423-10"), minute, F.lit("21.mp4?key=abc&x=1"))
    return table(spark, d, "pages").select("page_id", text.redact_key(url).alias("safe"), text.file_stem(url).alias("stem"), text.room_prefix(url).alias("room"))


@query("""SELECT o_orderkey, o_orderkey % 90000 AS seconds, (o_orderkey % 90000) // 3600 || ':' || lpad(CAST((o_orderkey % 90000 % 3600) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS clock,
  CAST(o_orderkey % 90000 AS DOUBLE) AS back FROM (SELECT o_orderkey * 37 AS o_orderkey FROM orders)""")
def clock_round_trip(spark, d):
    o = table(spark, d, "orders").select((F.col("o_orderkey") * 37).alias("o_orderkey"))
    o = o.withColumn("seconds", F.col("o_orderkey") % 90000).withColumn("clock", timeparse.seconds_to_clock(F.col("seconds")))
    return o.withColumn("back", timeparse.clock_to_seconds(F.col("clock")))


@query("""SELECT page_id, '<a title="' || page_id || chr(39) || 's & co">/x?é—&nope;' AS text, '&lt;' AS once FROM pages""")
def html_entities(spark, d):
    coded = F.concat(F.lit("&lt;a title&#61;&quot;"), F.col("page_id").cast("string"), F.lit("&apos;s &amp; co&#34;&gt;&#x2F;x?&eacute;&#8212;&nope;"))
    return table(spark, d, "pages").select("page_id", text.unescape_html(coded).alias("text"), text.unescape_html(F.lit("&amp;lt;")).alias("once"))


@query("""WITH b AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'Committee on Land' WHEN 1 THEN 'City Council' WHEN 2 THEN '' WHEN 3 THEN 'Parks Board' ELSE 'Stated Forum' END AS body, CASE WHEN page_id % 3 = 0 THEN 'City Hall, 1st floor' END AS place FROM pages)
  SELECT page_id, CASE WHEN place IS NOT NULL OR body IN ('Committee on Land', 'City Council', '') THEN 'New York City Council' ELSE body END AS body,
    CASE WHEN body IN ('City Council', 'Stated Forum') THEN 'Stated Meeting' WHEN body = '' THEN 'Meeting' ELSE body END AS title FROM b""")
def site_bodies(spark, d):
    kind = F.col("page_id") % 5
    body = F.when(kind == 0, "Committee on Land").when(kind == 1, "City Council").when(kind == 2, "").when(kind == 3, "Parks Board").otherwise("Stated Forum")
    place = F.when(F.col("page_id") % 3 == 0, "City Hall, 1st floor")
    return table(spark, d, "pages").select("page_id", text.site_body(place, body).alias("body"), text.meeting_title(F.lit("HEARING"), body).alias("title"))


@query(f"WITH {SECONDS} SELECT user_id, max(CASE WHEN event_type = 'view' THEN sec + 5 ELSE sec END) AS last_end FROM e GROUP BY user_id")
def last_ends(spark, d):
    rows = seconds(spark, d).select("user_id", F.col("sec").alias("t0"), F.when(F.col("event_type") == "view", F.col("sec") + 5).alias("t1"))
    return sequence.last_end(rows, "user_id")


@query(f"""WITH {SECONDS} SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY sec, sec + floor(value), event_id % 3, event_id) - 1 AS idx FROM e""")
def merged_parts(spark, d):
    e = seconds(spark, d).select("user_id", "event_id", (F.col("event_id") % 3).alias("part"), F.col("event_id").alias("ord"), F.col("sec").alias("t0"), (F.col("sec") + F.floor("value")).alias("t1"))
    return sequence.merge_parts(e, "user_id").select("user_id", "event_id", F.col("idx").cast("long").alias("idx"))


@query("""SELECT conv_id, turn AS idx, len(list_distinct(list(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))) > 1 AS near FROM conversations""")
def other_speakers_near(spark, d):
    rows = utterances(spark, d)
    return rows.select("conv_id", "idx", sequence.other_speaker_near(rows, "conv_id", "label").alias("near"))


@query("""WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
  i AS (SELECT user_id, n, list_filter([3, 5, 8, 13, 21], lambda k: k < n) AS f FROM n),
  w AS (SELECT user_id, list_concat(list_concat(f[1:4], [0, n - 1]), list_concat(list_transform(range(least(n, 8)), lambda k: CASE WHEN n <= 8 THEN k ELSE CAST(round_even(k * (n - 1) / 7.0, 0) AS BIGINT) END), range(n))) AS ks FROM i),
  o AS (SELECT user_id, unnest(ks) AS k, generate_subscripts(ks, 1) AS pos FROM w), d AS (SELECT user_id, k, row_number() OVER (PARTITION BY user_id ORDER BY min(pos)) AS r FROM o GROUP BY user_id, k)
  SELECT user_id, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS picks FROM d WHERE r <= 8 GROUP BY user_id""")
def sampled_indices(spark, d):
    n = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    telling = F.filter(F.array(*[F.lit(k) for k in (3, 5, 8, 13, 21)]), lambda k: k < F.col("n"))
    return n.select("user_id", joined(sequence.sample_indices(telling, F.col("n"))).alias("picks"))


@query("""WITH o(ord, low, high, value) AS (VALUES (1, 0, 1, 'UNKNOWN'), (2, 1, 3, 'B'), (3, 2, 90, 'C')), u AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN NULL WHEN role = 'system' THEN 'UNKNOWN' ELSE role END AS label FROM conversations),
  h AS (SELECT conv_id, turn, arg_min(value, CASE value WHEN 'UNKNOWN' THEN 100 ELSE 0 END + ord) AS v FROM conversations JOIN o ON turn BETWEEN low AND high GROUP BY ALL)
  SELECT conv_id, turn AS idx, CASE WHEN label IS NULL OR label = 'UNKNOWN' THEN coalesce(v, label) ELSE label END AS label FROM u LEFT JOIN h USING (conv_id, turn)""")
def range_fill(spark, d):
    rows = utterances(spark, d).select("conv_id", "idx", F.when(F.col("label") == "system", "UNKNOWN").when(F.col("label") != "user", F.col("label")).alias("label"))
    ranges = spark.createDataFrame([(1, 0, 1, "UNKNOWN"), (2, 1, 3, "B"), (3, 2, 90, "C")], "ord int, low long, high long, value string")
    own = rows.select("conv_id").distinct().crossJoin(F.broadcast(ranges))  # three constant rows
    return intervals.fill_ranges(rows, own, "conv_id", "label").select("conv_id", "idx", "label")


@query("""WITH t AS (SELECT p_brand AS source, p_name AS term, p_partkey AS ord FROM part), k AS (SELECT source, row_number() OVER (PARTITION BY lower(replace(term, 'l', '')) ORDER BY ord) AS n FROM t)
  SELECT source, count(*) AS n FROM k WHERE n = 1 GROUP BY source""")
def retained_term_sources(spark, d):
    rows = table(spark, d, "part").select(F.col("p_brand").alias("source"), F.col("p_name").alias("term"), F.col("p_partkey").alias("ord"))
    return terms.source_counts(terms.retained_terms(rows, F.lower(F.replace("term", F.lit("l"), F.lit("")))))


@query("""WITH i AS (SELECT l_orderkey AS event_id, l_linenumber AS ord, CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INTEGER) END AS seq, l_partkey AS item FROM lineitem)
  SELECT event_id, item FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY seq NULLS LAST, ord, item) AS n FROM i) WHERE n = 1""")
def first_agenda_items(spark, d):
    seq = F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.struct("l_linenumber", "l_partkey").alias("ord"), seq.alias("seq"), F.col("l_partkey").alias("item"))
    return readers.first_items(items, sequence="seq").select("event_id", "item")


# Functions of one column, over whole tables


@query("""WITH x AS (SELECT p_partkey, p_name || ' & ' || p_brand || ' d' || chr(39) || 'été' AS t FROM part)
  SELECT p_partkey, trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-') AS plain, trim(substr(trim(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '-'), 1, 12), '-') AS short,
    trim(regexp_replace(replace(replace(replace(lower(t), 'é', 'e'), '&', ' and '), chr(39), ''), '[^a-z0-9]+', '-', 'g'), '-') AS site,
    lpad(CAST(1 + p_partkey % 12 AS VARCHAR), 2, '0') || lpad(CAST(p_partkey % 60 AS VARCHAR), 2, '0') || '-pm' AS at FROM x""")
def slugs(spark, d):
    name = F.concat("p_name", F.lit(" & "), "p_brand", F.lit(" d'été"))
    clock = F.format_string(" %d:%02d PM", 1 + F.col("p_partkey") % 12, F.col("p_partkey") % 60)
    return table(spark, d, "part").select("p_partkey", text.slug(name).alias("plain"), text.slug(name, 12).alias("short"), text.site_slug(name).alias("site"), text.time_slug(clock).alias("at"))


@query(r"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(array_to_string(list_filter(list_concat(string_split(text, ' '), [',', '(', ' ', role, ')', '''s']), lambda t: trim(t, ' ') <> ''), ' '),
  '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+([,.;:!?%)\]])', '\1', 'g'), '([(\[])[\s\x0B\x1C-\x1F\x{85}\p{Z}]+', '\1', 'g'), '[\s\x0B\x1C-\x1F\x{85}\p{Z}]+(''[\p{L}\p{N}_])', '\1', 'g'), ' ') AS text FROM conversations""")
def joined_tokens(spark, d):
    tokens = F.concat(F.split("text", " "), F.array(F.lit(","), F.lit("("), F.lit(" "), F.col("role"), F.lit(")"), F.lit("'s")))
    return table(spark, d, "conversations").select("conv_id", "turn", text.join_tokens(tokens).alias("text"))


@query("""WITH x AS (SELECT o_orderkey, o_orderdate AS moment, o_orderkey * 37 % 20000 AS s FROM orders)
  SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%d:%02d', s // 60, s % 60) END AS clock,
    CASE WHEN (s + 30) // 60 < 60 THEN ((s + 30) // 60) || ' min' ELSE ((s + 30) // 3600) || 'h ' || ((s + 30) // 60 % 60) || 'm' END AS lasts, strftime(moment, '%b %-d, %Y') AS day, strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM x""")
def display_times(spark, d):
    o = table(spark, d, "orders").withColumn("s", F.col("o_orderkey") * 37 % 20000)
    at = F.col("o_orderdate").cast("timestamp")
    return o.select("o_orderkey", timeparse.display_clock(F.col("s") + 0.4).alias("clock"), timeparse.display_duration(F.col("s")).alias("lasts"), timeparse.display_date(at).alias("day"), timeparse.iso_stamp(at).alias("stamp"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'soon' ELSE strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00') END AS mailed, date_trunc('second', ts) AS recorded FROM events""")
def source_times(spark, d):
    e = table(spark, d, "events").withColumn("at", F.date_trunc("second", F.col("ts").cast("timestamp")))
    mail = F.when(F.col("event_id") % 4 == 0, "soon").otherwise(F.date_format("at", "EEE, d MMM yyyy HH:mm:ss 'GMT'"))
    name = F.concat(F.lit("ROOM_"), F.date_format("at", "yyMMdd-HHmmss"), F.when(F.col("event_id") % 2 == 0, "fix.mp4").otherwise(".mp4"))
    return e.select("event_id", timeparse.mail_date(mail).alias("mailed"), timeparse.recording_time(name).cast("timestamp_ntz").alias("recorded"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || ' Works' WHEN 1 THEN c_mktsegment || ' Board' ELSE c_name END AS role, c_custkey % 3 <> 2 AS introduces, c_custkey % 3 = 0 AS mentions FROM customer""")
def speaker_hints(spark, d):
    kind = F.col("c_custkey") % 3
    said = F.when(kind == 0, F.concat(F.lit("My name is Ana Lee from "), "c_mktsegment", F.lit(" Works. Thanks"))).when(kind == 1, F.concat(F.lit("I am Cy Ray, director of "), "c_mktsegment", F.lit(" Board; hello"))).otherwise("hello all")
    return table(spark, d, "customer").select("c_custkey", text.role_hint(F.concat(F.lit("Public - "), "c_name"), said).alias("role"), text.is_introduction(said).alias("introduces"), text.mentions_name(said, F.lit("Ana Lee")).alias("mentions"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Introduction 12' WHEN 1 THEN 'LU ' || p_size || 'A' END AS label, CASE p_partkey % 3 WHEN 0 THEN 'the ' || p_name WHEN 1 THEN p_name ELSE 'Nothing on ' || p_name END AS topic FROM part""")
def agenda_texts(spark, d):
    kind = F.col("p_partkey") % 3
    said = F.when(kind == 0, F.concat(F.lit("Intro twelve calls on the "), "p_name", F.lit("."))).when(kind == 1, F.concat(F.lit("LU "), F.col("p_size").cast("string"), F.lit("a: "), "p_name")).otherwise(F.concat(F.lit("Nothing on "), "p_name"))
    return table(spark, d, "part").select("p_partkey", text.agenda_label(said).alias("label"), text.agenda_topic(said).alias("topic"))


@query("""SELECT s_suppkey, k AS ord, ['Ana B. ' || s_suppkey || ' Lee, Jr.', 'Ana B ' || s_suppkey || ' Lee, Jr', 'Ana ' || s_suppkey || ' Lee, Jr.', 'Ana ' || s_suppkey || ' Lee'][k + 1] AS variant, replace(['Ana B. ' || s_suppkey || ' Lee Jr.', 'Ana B ' || s_suppkey || ' Lee Jr', 'Ana ' || s_suppkey || ' Lee Jr.', 'Ana ' || s_suppkey || ' Lee'][k + 1], ' ', '-') AS term FROM supplier, (SELECT unnest([0, 1, 2, 3]) AS k)""")
def name_spellings(spark, d):
    names = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Ana B. "), F.col("s_suppkey").cast("string"), F.lit(" Lee, Jr.")).alias("name"))
    out = terms.expand_names(names.select("name"), 4)
    key = F.regexp_extract("name", "([0-9]+)", 1).cast("long")
    return out.select(key.alias("s_suppkey"), F.col("ord").cast("int").alias("ord"), "variant", text.bias_term(F.col("variant")).alias("term"))


@query("""SELECT p_partkey, CASE WHEN length(p_name) > 10 THEN rtrim(substr(p_name, 1, 9)) || '…' ELSE p_name END AS clip, rpad(CASE WHEN length(p_name) > 14 THEN rtrim(substr(p_name, 1, 13)) || '…' ELSE p_name END, 14, ' ') AS cell,
  CASE p_partkey % 3 WHEN 0 THEN replace(trim(p_name), ' ', '_') WHEN 1 THEN p_brand END AS source, 'Council Staff - ' || p_name AS styled, CASE WHEN p_partkey % 2 = 0 THEN 'Member of the Public - ' || p_name ELSE p_name END AS mapped FROM part""")
def labels_shown(spark, d):
    kind, name = F.col("p_partkey") % 3, F.col("p_name")
    source = text.source_label(F.lit("unknown"), F.when(kind == 0, name).otherwise(" "), F.when(kind == 1, F.col("p_brand")))
    mapped = text.mapped_speaker(name, F.when(F.col("p_partkey") % 2 == 0, "Public witness").otherwise("chair"))
    return table(spark, d, "part").select("p_partkey", text.clip(name, 10).alias("clip"), text.fixed_width(name, 14).alias("cell"), source.alias("source"), text.styled_speaker(F.lit("council staff - An Le"), name).alias("styled"), mapped.alias("mapped"))


@query(f"""WITH {UTTERANCES}, x AS (SELECT conv_id, idx, label, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text, CAST(t0 AS BIGINT) // 1000 AS s FROM u), c AS (SELECT *, printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS k FROM x)
  SELECT conv_id, idx, '[' || idx || '] [' || k || '] ' || CASE WHEN idx % 3 = 0 THEN 'Speaker' ELSE label END || ': ' || text AS line, '[' || idx || '] ' || k || '-' || k || ':' || CASE WHEN idx % 3 = 0 THEN '' ELSE ' ' || label || ':' END || ' ' || text AS span, '[' || k || '] ' || text AS caption FROM c""")
def transcript_lines(spark, d):
    rows = utterances(spark, d).withColumn("text", text.clean_text(F.col("text"))).withColumn("who", F.when(F.col("idx") % 3 != 0, F.col("label")))
    idx, clock, who, said = F.col("idx"), timeparse.seconds_to_clock(F.col("t0") / 1000), F.col("who"), F.col("text")
    return rows.select("conv_id", "idx", text.transcript_line(idx, clock, who, said).alias("line"), text.span_line(idx, clock, clock, who, said).alias("span"), text.caption_line(clock, said).alias("caption"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(printf('%.3f', l_extendedprice * l_tax / 7) AS DOUBLE) AS seconds, CAST(printf('%.3f', l_linenumber + (l_partkey % 2000) / 2000.0) AS DOUBLE) AS middle FROM lineitem""")
def rounded_seconds(spark, d):
    li = table(spark, d, "lineitem")
    middle = F.col("l_linenumber") + (F.col("l_partkey") % 2000) / F.lit(2000.0)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", scalar.round_seconds(F.col("l_extendedprice") * F.col("l_tax") / 7).alias("seconds"), scalar.round_seconds(middle).alias("middle"))


@query("""WITH x AS (SELECT p_partkey, p_size * 600 AS s FROM part), f AS (SELECT *, round_even(20 * (s / 3600), 0) AS h, round_even(30 * (s / 3600), 0) AS m FROM x)
  SELECT f.p_partkey, CAST(CASE WHEN f.p_partkey % 2 = 0 THEN greatest(12, h) WHEN s >= 3600 THEN greatest(35, m) ELSE 0 END AS INTEGER) AS least_chapters, greatest(1, length(p_name) // 4) AS tokens, s / 3600 * 0.5 AS cost, CASE WHEN f.p_partkey % 5 = 0 THEN NULL ELSE p_size / 1000 END AS sec FROM f JOIN part USING (p_partkey)""")
def estimates(spark, d):
    s = F.col("p_size") * 600
    kind = F.when(F.col("p_partkey") % 2 == 0, "HEARING").otherwise("STATED_MEETING")
    given = F.when(F.col("p_partkey") % 5 == 0, "soon").otherwise(F.col("p_size").cast("string"))
    cost = scalar.within_budget(scalar.vendor_cost(s, F.lit(0.5)), 1e6)
    return table(spark, d, "part").select("p_partkey", scalar.chapter_floor(kind, s).alias("least_chapters"), scalar.token_estimate(F.col("p_name"), 4).alias("tokens"), cost.alias("cost"), scalar.milliseconds(given).alias("sec"))


@query("""SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 'VOICE_VOTE' WHEN 'click' THEN 'TESTIMONY' ELSE 'REMARKS' END AS kind, CASE WHEN event_id % 2 = 0 THEN 'HEARING' ELSE '' END AS tags, CASE WHEN event_type = 'view' THEN 'HEARING,VOTE' ELSE 'HEARING' END AS inferred FROM events""")
def coerced_types(spark, d):
    kind = scalar.chapter_type(F.when(F.col("event_type") == "view", " voice vote").when(F.col("event_type") == "click", "Testimony").otherwise(F.col("event_type")))
    tags = scalar.known_tags(F.array(F.lit("SONG"), F.when(F.col("event_id") % 2 == 0, "HEARING").otherwise("X")))
    return table(spark, d, "events").select("user_id", "event_id", kind.alias("kind"), F.array_join(tags, ",").alias("tags"), F.array_join(scalar.tags_from_chapters(F.array(kind), F.lit("HEARING")), ",").alias("inferred"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' ' || p_type WHEN 1 THEN 'matter of ' || p_brand END AS topic FROM part""")
def topics(spark, d):
    kind = F.col("p_partkey") % 4
    title = F.when(kind == 0, F.concat(F.lit(" "), "p_name", F.lit("\r\n"), "p_type", F.lit("."))).when(kind == 2, "Roll call of all").otherwise(F.concat(F.lit("Body "), "p_name"))
    matter = F.when(kind == 1, F.concat(F.lit("matter of "), "p_brand"))
    return table(spark, d, "part").select("p_partkey", scalar.event_topic(matter, title, F.concat(F.lit("body "), "p_name")).alias("topic"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'b' || user_id WHEN 2 THEN 'x' || event_id END AS reply, CASE WHEN event_id % 4 = 3 THEN 'no' END AS refused, CAST(CASE WHEN event_id % 4 = 0 THEN user_id ELSE 0 END AS BIGINT) AS cached FROM events""")
def model_replies(spark, d):
    e = table(spark, d, "events").withColumn("k", F.col("event_id") % 4)
    word = lambda c: F.col(c).cast("string")
    message = F.when(F.col("k") == 0, F.concat(F.lit('{"content":"'), "event_type", F.lit('"}'))).when(F.col("k") == 1, F.concat(F.lit('{"content":[{"text":"b"},{"type":"image"},"'), word("user_id"), F.lit('"]}')))
    message = message.when(F.col("k") == 2, F.concat(F.lit('{"content":"y","tool_calls":[{"function":{"arguments":"x'), word("event_id"), F.lit('"}}]}'))).otherwise('{"refusal":"no","content":"z"}')
    body = F.concat(F.lit('{"choices":[{"message":'), message, F.lit("}]}"))
    usage = F.when(F.col("k") == 0, F.concat(F.lit('{"prompt_tokens_details":{"cached_tokens":'), word("user_id"), F.lit("}}"))).otherwise("{}")
    return e.select("event_id", scalar.reply_text(body).alias("reply"), scalar.refusal(body).alias("refused"), scalar.cached_tokens(usage).alias("cached"))


@query("""SELECT page_id, CAST(page_id AS VARCHAR) AS a, page_id % 3 = 1 AS usable, page_id % 50 AS n_sources, least(page_id % 50, 2) AS kept FROM pages""")
def tolerant_json(spark, d):
    """The key of a reply in a fence, among words or with commas too many; what can stand for a stage's work."""
    p = table(spark, d, "pages").withColumn("id", F.col("page_id").cast("string"))
    shape = F.col("page_id") % 3
    reply = F.when(shape == 0, F.concat(F.lit('```json\n{"a": '), "id", F.lit("}\n```"))).when(shape == 1, F.concat(F.lit('{"a": '), "id", F.lit("}"))).otherwise(F.concat(F.lit('Here: {"a": '), "id", F.lit(", } so")))
    stored = F.when(shape == 0, '{"chapters": []}').when(shape == 1, '{"chapters": [{"t": 1}]}').otherwise('{"chapters": [1]')
    chunk = F.transform(F.sequence(F.lit(0), F.col("page_id") % 50), lambda i: F.when(i == 0, "{}").otherwise('{"web":{"title":"t","uri":"u"}}'))
    found = scalar.compact_grounding(F.concat(F.lit('{"groundingChunks":['), F.array_join(chunk, ","), F.lit("]}")), 2)
    return p.select("page_id", scalar.json_object(reply, "a string")["a"].alias("a"), scalar.usable(stored, "chapters").alias("usable"), found["n_sources"].cast("long").alias("n_sources"), F.size(found["sources"]).cast("long").alias("kept"))


# Registry upkeep


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 AND r <= 40 THEN CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment WHEN 2 THEN '' END END AS topic
  FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey % 3 ORDER BY c_custkey) AS r FROM customer)""")
def topic_backfill(spark, d):
    c = table(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("meeting_key"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).alias("legistar_event_id"), F.lit("f").alias("viebit_filename"), F.lit(None).cast("string").alias("event_topic"), F.when(F.col("c_custkey") % 4 == 0, "STATED_MEETING").otherwise("HEARING").alias("meeting_type"))
    found = c.filter("c_custkey % 4 in (1, 2)").select(F.col("c_custkey").alias("meeting_key"), F.when(F.col("c_custkey") % 4 == 1, F.col("c_mktsegment")).alias("topic"))
    return registry.backfill_topics(rows, found, 40).select(F.col("meeting_key").alias("k"), F.col("event_topic").alias("topic"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0 AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1998-06-24'""")
def stale_recordings(spark, d):
    o = table(spark, d, "orders")
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    rows = o.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "f").alias("viebit_filename"), F.lit(None).cast("long").alias("legistar_event_id"), F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.substring(at, 1, 10), F.lit(" soon"))).when(F.col("o_orderkey") % 2 == 0, F.concat(at, F.lit("Z"))).alias("viebit_pub_date"), at.alias("discovered_at"))
    return registry.stale_unmatched(rows, "1995-01-01", F.lit("1998-07-01 00:00:00").cast("timestamp")).select("o_orderkey")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey % 5 = 0) GROUP BY 1")
def retracted_results(spark, d):
    gone = table(spark, d, "orders").filter("o_custkey % 5 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return registry.retract(table(spark, d, "lineitem"), gone, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_custkey % 4 = 0 THEN 'failed' WHEN o_custkey % 100 >= 60 THEN 'pending' ELSE 'waiting' END AS outcome FROM orders""")
def poll_outcomes(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_custkey") % 4 == 0, "CANCELLED").otherwise("RUNNING")
    return table(spark, d, "orders").select("o_orderkey", registry.poll_outcome(status, F.col("o_custkey") % 100, 60.0).alias("outcome"))


@query("""SELECT conv_id, 'Meeting ' || conv_id || chr(10) || string_agg('[' || turn || '] ' || role, chr(10) ORDER BY turn) || chr(10) || 'Name them.' AS prompt FROM conversations GROUP BY conv_id""")
def prompts(spark, d):
    line = F.format_string("[%d] %s", "turn", "role")
    return terms.prompt(table(spark, d, "conversations"), ["conv_id"], "turn", line, "Meeting {conv_id}\n{lines}\nName them.")


@query("""SELECT o_orderkey, '{"at":{"a":' || o_custkey || ',"b":null},"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' AS value FROM orders""")
def row_snapshots(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"), F.struct(F.lit(None).cast("string").alias("b"), F.col("o_custkey").alias("a")).alias("at"))
    return rows.select(F.col("key").alias("o_orderkey"), writers.json_document(rows, pretty=False).alias("value"))


@query(f"""WITH {SECONDS} SELECT event_id AS meeting_key, CAST(event_id % 3 AS INTEGER) AS part, CAST(10.0 + event_id % 50 AS DOUBLE) AS t0, CAST(12.5 + event_id % 50 AS DOUBLE) AS t1, 'said ' || event_type AS text, CASE WHEN event_id % 2 = 0 THEN 'speaker_' || (user_id % 5) ELSE 'UNKNOWN' END || '_part' AS label FROM e""")
def vendor_records(spark, d):
    e = table(spark, d, "events").withColumn("at", (F.col("event_id") % 50) * 1000)
    who = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("speaker "), (F.col("user_id") % 5).cast("string"))).otherwise("unk")
    body = F.format_string('{"utterances":[{"text":" said  %s","start":%d,"end":%d,"speaker":"%s"},{"text":"","start":1,"end":2},{"text":"x","start":5,"end":5}]}', "event_type", F.col("at"), F.col("at") + 2500, who)
    replies = e.select(F.col("event_id").alias("meeting_key"), (F.col("event_id") % 3).cast("int").alias("part"), F.lit(10.0).alias("offset"), F.lit("_part").alias("suffix"), body.alias("body"))
    return model_io.vendor_segments(replies, "utterances", 0.001)


@query("""SELECT page_id, CAST(page_id AS VARCHAR) AS id, CASE page_id % 6 WHEN 3 THEN 'he said "no", twice' ELSE url END AS url, CASE WHEN page_id % 6 IN (2, 5) THEN 1 ELSE 2 END AS n FROM pages""")
def repaired_replies(spark, d):
    """Replies with bare keys, single quotes, quotes within words, missing closing signs and commas, read all the same."""
    p, shape, i, url = table(spark, d, "pages"), F.col("page_id") % 6, F.col("page_id").cast("string"), F.col("url")
    told = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    broken = (
        F.when(shape == 0, told("Here you are:\n{id: ", i, ", 'url': '", url, "', items: [1, 2]}\nDone."))
        .when(shape == 1, told('```json\n{"id": ', i, ', "url": "', url, '", "items": [1, 2,],}\n```'))
        .when(shape == 2, told('{"id": ', i, ', "url": "', url, '", "items": [1'))
        .when(shape == 3, told('{"id": ', i, ' "url": "he said "no", twice", "items": ["a", "b"]}'))
        .when(shape == 4, told("{'id': ", i, ", // the page\n 'url': \"", url, '" "items": [True, None]}'))
        .otherwise(told('{"id": ', i, ', "url": "', url, '", "items": [{"a": 1}}'))
    )
    read = F.from_json(json_repair.repaired_json(broken), "id string, url string, items array<string>")
    return p.select("page_id", read.alias("r")).select("page_id", "r.id", "r.url", F.size("r.items").alias("n"))


@query(f"""WITH {UTTERANCES}, v AS (SELECT conv_id, idx, t0 / 1000 AS t, CASE idx % 3 WHEN 0 THEN 'Hello, my name is Ana K' || chr(97 + CAST(conv_id % 26 AS INTEGER)) || chr(97 + CAST(idx % 26 AS INTEGER)) || ' from ' || label WHEN 1 THEN 'We call the next panel' ELSE 'so be it' END AS x FROM u),
  w AS (SELECT *, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o) AS win FROM v WINDOW o AS (PARTITION BY conv_id ORDER BY idx)),
  h AS (SELECT *, regexp_extract_all(win, 'is (Ana K[a-z]+)', 1) AS names FROM w WHERE contains(x, 'my name is') OR contains(x, 'call the')),
  e AS (SELECT conv_id, idx, t, win, unnest(CASE WHEN len(names) > 0 THEN names ELSE [''] END) AS name, generate_subscripts(CASE WHEN len(names) > 0 THEN names ELSE [''] END, 1) AS k FROM h),
  f AS (SELECT *, CASE WHEN name = '' THEN lower(win[1:120]) ELSE lower(name) END AS key FROM e),
  g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, key ORDER BY idx, k) AS n FROM f),
  p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY idx, k) AS place FROM g WHERE n = 1)
  SELECT conv_id, place::INTEGER AS place, '[' || idx || '] ' || CAST(floor(t) AS BIGINT) // 3600 || ':' || lpad((CAST(floor(t) AS BIGINT) % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((CAST(floor(t) AS BIGINT) % 60)::VARCHAR, 2, '0') || ': '
    || CASE WHEN name = '' THEN 'possible panel introduction' ELSE 'possible named speaker ' || name END || ' | ' || win[1:220] AS hint FROM p WHERE place <= 5""")
def hint_lines(spark, d):
    """The first five hints of each conversation, whose turns name people and panels."""
    letter = lambda c: F.char(F.lit(97) + c % 26)
    said = F.when(F.col("idx") % 3 == 0, F.concat(F.lit("Hello, my name is Ana K"), letter(F.col("conv_id")), letter(F.col("idx")), F.lit(" from "), "label")).when(F.col("idx") % 3 == 1, "We call the next panel").otherwise("so be it")
    rows = utterances(spark, d).select("conv_id", "idx", (F.col("t0") / 1000).alias("t0"), said.alias("text"))
    return sequence.speaker_hints(rows, "conv_id", ("FROM",), 5)


@query(f"""WITH RECURSIVE {SECONDS}, ev AS (SELECT user_id, event_id, sec, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM e WHERE event_type = 'signup'),
  rc AS (SELECT user_id, list(struct_pack(id := event_id, sec := sec) ORDER BY event_id) AS rs FROM e WHERE event_type = 'purchase' GROUP BY user_id),
  f AS (SELECT user_id, 0::BIGINT AS n, CAST([] AS BIGINT[]) AS taken, NULL::BIGINT AS event, NULL::BIGINT AS got FROM rc
    UNION ALL SELECT f.user_id, ev.n, CASE WHEN g IS NULL THEN f.taken ELSE list_append(f.taken, g) END, ev.event_id, g
    FROM (SELECT f.*, ev.*, list_filter(rc.rs, lambda r: abs(r.sec - ev.sec) <= 200000 AND NOT list_contains(f.taken, r.id))[1].id AS g FROM f JOIN ev ON ev.user_id = f.user_id AND ev.n = f.n + 1 JOIN rc ON rc.user_id = f.user_id) q(user_id, n0, taken, e0, g0, u2, event_id, sec, n, g), LATERAL (SELECT q.taken, q.user_id) f(taken, user_id), LATERAL (SELECT q.n, q.event_id) ev(n, event_id))
  SELECT event, got AS candidate FROM f WHERE got IS NOT NULL""")
def first_free_in_turn(spark, d):
    """Sign-ups that, one after the other, each take the first purchase of their user within a time that is still free."""
    e = seconds(spark, d)
    left = e.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("event"), F.col("sec").alias("t"))
    right = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("candidate"), F.col("sec").alias("t"))
    return discovery.first_free(discovery.within(left, right, "user_id", 200000.0))


@query(f"""WITH {UTTERANCES}, m AS (SELECT conv_id, max(t0) / 1000 + 5 AS dur FROM u GROUP BY conv_id),
  c AS (SELECT conv_id, idx, t0 / 1000 AS s, CASE WHEN idx % 4 = 2 THEN '' ELSE label END AS title, row_number() OVER o AS n, lead(t0 / 1000) OVER o AS nx FROM u WHERE idx % 2 = 0 WINDOW o AS (PARTITION BY conv_id ORDER BY idx)),
  d AS (SELECT conv_id, idx, n, s, greatest(s + 1, coalesce(nx, dur)) AS f, CASE WHEN title = '' THEN 'chapter-' || n ELSE title END AS base FROM c JOIN m USING (conv_id)),
  g AS (SELECT *, CASE WHEN row_number() OVER r = 1 THEN base ELSE base || '-' || row_number() OVER r END AS slug FROM d WINDOW r AS (PARTITION BY conv_id, base ORDER BY idx)),
  x AS (SELECT g.conv_id, g.idx, u.idx AS line, round(u.t0 / 1000, 3) AS t, array_to_string(regexp_extract_all(text, '[^\\s]+'), ' ') AS x FROM g JOIN u ON u.conv_id = g.conv_id AND u.t0 / 1000 >= s AND u.t0 / 1000 < f),
  a AS (SELECT conv_id, idx, list(struct_pack(t := t, x := x) ORDER BY line) AS rs FROM x WHERE x <> '' GROUP BY conv_id, idx),
  t AS (SELECT conv_id, idx, list_reduce(list_transform(rs, lambda r: [r]), lambda a, r: CASE WHEN r[1].t - a[-1].t > 18 OR length(a[-1].x) > 280 THEN list_concat(a, r)
    ELSE list_concat(a[:-2], [struct_pack(t := a[-1].t, x := a[-1].x || ' ' || r[1].x)]) END) AS turns FROM a)
  SELECT conv_id, count(*) AS chapters, string_agg(slug, ',' ORDER BY g.idx) AS slugs, sum(coalesce(len(turns), 0))::BIGINT AS turns, md5(string_agg(coalesce(array_to_string(list_transform(turns, lambda y: y.x), '|'), ''), '/' ORDER BY g.idx)) AS said
  FROM g LEFT JOIN t USING (conv_id, idx) GROUP BY conv_id""")
def caption_documents(spark, d):
    """Each conversation as a document: its turns are captions, every second one begins a chapter, some without a title."""
    u = utterances(spark, d).withColumn("slug", F.col("conv_id").cast("string")).withColumn("t0", F.col("t0") / 1000)
    none = F.lit(None).cast("string")
    meetings = u.groupBy("slug").agg((F.max("t0") + 5).alias("duration_sec")).select("slug", none.alias("body"), none.alias("title"), none.alias("topic"), none.alias("date"), none.alias("time"), "duration_sec", F.struct(none.alias("url"), none.alias("poster")).alias("video"), F.array().cast("array<string>").alias("summary"), F.array().cast("array<string>").alias("tags"))
    chapters = u.filter("idx % 2 = 0").select("slug", "idx", F.col("t0").alias("start_sec"), F.lit("HEARING").alias("type"), F.when(F.col("idx") % 4 == 2, "").otherwise(F.col("label")).alias("title"), none.alias("summary"))
    docs = documents.caption_documents(meetings, chapters, u.select("slug", "idx", "t0", "text"))
    turns = F.transform("chapters", lambda c: F.array_join(F.transform(c["utterances"], lambda x: x["text"]), "|"))
    return docs.select(
        F.col("slug").cast("long").alias("conv_id"), F.size("chapters").cast("long").alias("chapters"), F.array_join("chapters.slug", ",").alias("slugs"),
        F.aggregate("chapters", F.lit(0).cast("long"), lambda n, c: n + F.size(c["utterances"])).alias("turns"), F.md5(F.array_join(turns, "/")).alias("said"),
    )
