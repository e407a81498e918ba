"""Column functions on literal inputs; columns are made once a session is there."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions import scalar, text, timeparse


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


CASES = [
    (lambda: text.repair_decimals(F.lit("$1. 5 billion")), "$1.5 billion"),
    (lambda: text.repair_decimals(F.lit("$1. 234. 5 billion for 3. 2 percent")), "$1.234.5 billion for 3.2 percent"),
    (lambda: text.repair_decimals(F.lit("$125 .8 billion")), "$125.8 billion"),
    (lambda: text.repair_decimals(F.lit("held in 2012. 5 members voted no.")), "held in 2012. 5 members voted no."),
    (lambda: text.repair_decimals(F.lit(None).cast("string")), ""),
    (lambda: text.clean_text(F.lit(" a  b\n c ")), "a b c"),
    (lambda: text.safe_key(F.lit("--a b/c--")), "a-b-c"),
    (lambda: text.safe_key(F.lit("///")), "meeting"),
    (lambda: text.slug(F.lit("Committee on Land-Use & Zoning!")), "committee-on-land-use-zoning"),
    (lambda: text.slug(F.lit("ab " * 60), 5), "ab-ab"),
    (lambda: text.site_slug(F.lit("Café & Crème d'été")), "cafe-and-creme-dete"),
    (lambda: text.time_slug(F.lit(" 9:05 AM ")), "0905-am"),
    (lambda: text.time_slug(F.lit("To be announced")), "to-be-announced"),
    (lambda: text.join_tokens(F.array(*[F.lit(x) for x in ("Hello", ",", "(", "you", ")", "'re", "it", ".")])), "Hello, (you)'re it."),
    (lambda: text.clean_speaker(F.lit("Council Member  Ana  Lee")), "Ana Lee"),
    (lambda: text.clean_speaker(F.lit("unk")), "UNKNOWN"),
    (lambda: text.speaker_base_name(F.lit("Member of the Public - Dr. Ana  Lee")), "Ana Lee"),
    (lambda: text.sound_code(F.lit("Ashcraft")), "A226"),
    (lambda: text.sound_code(F.lit("")), ""),
    (lambda: text.role_hint(F.lit("x"), F.lit("I am director of Parks Now. Thanks")), "Parks Now"),
    (lambda: text.role_hint(F.lit("Public - Tenants"), F.lit("hello")), "Tenants"),
    (lambda: text.is_introduction(F.lit("good day, my name is Ana")), True),
    (lambda: text.mentions_name(F.lit("Thank you Ms. Lee"), F.lit("Ana Lee")), True),
    (lambda: text.agenda_label(F.lit("Intro twelve calls on the agency")), "Introduction 12"),
    (lambda: text.agenda_label(F.lit("LU 5a: a plan")), "LU 5A"),
    (lambda: text.agenda_label(F.lit("Nothing")), None),
    (lambda: text.agenda_topic(F.lit("Resolution 7 calls on the state to act.")), "the state to act"),
    (lambda: text.bias_term(F.lit(" New York,  City ")), "New-York-City"),
    (lambda: text.name_variants(F.lit("Ana B. Lee, Jr.")), ["Ana B. Lee, Jr.", "Ana B Lee, Jr", "Ana Lee, Jr.", "Ana Lee"]),
    (lambda: text.clip(F.lit("abcdef"), 4), "abc…"),
    (lambda: text.source_label(F.lit("unknown"), F.lit("speaker 7")), "speaker_7"),
    (lambda: text.redact_key(F.lit("http://x/y?a=1&key=SECRET")), "http://x/y?a=1&key=[redacted]"),
    (lambda: text.base64_url(F.lit("aHR0cDovL3g%3D")), "http://x"),
    (lambda: text.base64_url(F.lit("%%%")), None),
    (lambda: text.file_stem(F.lit("https://h/p/NYCC-1_250423-100921.mp4?x=1")), "NYCC-1_250423-100921"),
    (lambda: text.room_prefix(F.lit("NYCC-1_250423-100921.mp4")), "NYCC-1"),
    (lambda: text.mapped_speaker(F.lit("Ana Lee"), F.lit("Public witness")), "Member of the Public - Ana Lee"),
    (lambda: text.styled_speaker(F.lit("Council Staff - An Le"), F.lit("Ana Lee")), "Council Staff - Ana Lee"),
    (lambda: timeparse.clock_to_seconds(F.lit("1:02:03")), 3723.0),
    (lambda: timeparse.clock_to_seconds(F.lit("02:03.5")), 123.5),
    (lambda: timeparse.clock_to_seconds(F.lit("x")), None),
    (lambda: timeparse.seconds_to_clock(F.lit(-3.2)), "0:00:00"),
    (lambda: timeparse.seconds_to_clock(F.lit(3723.9)), "1:02:03"),
    (lambda: timeparse.display_clock(F.lit(59.6)), "1:00"),
    (lambda: timeparse.mail_date(F.lit("Wed, 23 Apr 2025 18:42:00 GMT")), "2025-04-23T18:42:00+00:00"),
    (lambda: timeparse.mail_date(F.lit("some day")), "some day"),
    (lambda: F.date_format(timeparse.recording_time(F.lit("NYCC_250423-100921fix")), "yyyy-MM-dd HH:mm:ss"), "2025-04-23 10:09:21"),
    (lambda: F.date_format(timeparse.event_time(F.lit("2025-04-23T00:00:00"), F.lit("2:05 PM")), "yyyy-MM-dd HH:mm"), "2025-04-23 14:05"),
    (lambda: scalar.confidence(F.lit("High")), 0.9),
    (lambda: scalar.confidence(F.lit("1.7")), 1.0),
    (lambda: scalar.confidence(F.lit("?")), 0.5),
    (lambda: scalar.chapter_floor(F.lit("HEARING"), F.lit(4 * 3600)), 80),
    (lambda: scalar.chapter_floor(F.lit("STATED_MEETING"), F.lit(5400)), 45),
    (lambda: scalar.chapter_floor(F.lit("STATED_MEETING"), F.lit(600)), 0),
    (lambda: scalar.chapter_type(F.lit("voice vote")), "VOICE_VOTE"),
    (lambda: scalar.chapter_type(F.lit("song")), "REMARKS"),
    (lambda: scalar.event_topic(F.lit(""), F.lit("Oversight\r\nSchool Safety."), F.lit("Committee")), "Oversight School Safety"),
    (lambda: scalar.event_topic(F.lit("See attached"), F.lit(None).cast("string"), F.lit("x")), None),
    (lambda: scalar.json_first(F.lit('{"a":"","b":"x"}'), "$.a", "$.b"), "x"),
    (lambda: scalar.json_object(F.lit('```json\n{"a": 1}\n```'), "a int")["a"], 1),
    (lambda: scalar.reply_text(F.lit('{"choices":[{"message":{"content":[{"text":"a"},{"text":"b"}]}}]}')), "ab"),
    (lambda: scalar.cached_tokens(F.lit('{"prompt_tokens_details":{"cached_tokens":7}}')), 7),
    (lambda: scalar.milliseconds(F.lit("1500")), 1.5),
    (lambda: scalar.token_estimate(F.lit(""), 4), 1),
    (lambda: text.repair_decimals(F.lit("1. 2. 3. 4. 5. 6. 7. 8. 9. 5 billion")), "1.2.3.4.5.6.7.8.9.5 billion"),
    (lambda: text.repair_decimals(F.lit("In 2012. 5 people. 3. 5 percent")), "In 2012. 5 people. 3.5 percent"),
    (lambda: text.unescape_html(F.lit("a &amp;lt; &#x1F600; &#0; &#xD800; &x &hellip;")), "a &lt; \U0001f600 \ufffd \ufffd &x \u2026"),
    (lambda: scalar.round_seconds(F.lit(1.0005)), 1.0),
    (lambda: scalar.round_seconds(F.lit(0.0625)), 0.062),
    (lambda: scalar.round_seconds(F.lit(None).cast("double")), 0.0),
    (lambda: scalar.json_text(F.lit('So: {"a": [1, 2,],} end')), '{"a": [1, 2]}'),
    (lambda: scalar.json_text(F.lit("no json")), "no json"),
    (lambda: scalar.json_text(F.lit(None).cast("string")), None),
    (lambda: scalar.usable(F.lit('{"segments": [], "backend": "x"}'), "segments", may_be_empty=True, backend="x"), True),
    (lambda: scalar.usable(F.lit('{"segments": [], "backend": "x"}'), "segments", may_be_empty=True, backend="y"), False),
    (lambda: scalar.usable(F.lit('{"segments": [1'), "segments"), False),
    (lambda: scalar.usable(F.lit(""), "segments"), False),
    (lambda: scalar.usable(F.lit(None).cast("string"), "segments"), False),
    (lambda: scalar.compact_grounding(F.lit('{"webSearchQueries":["a"," "],"groundingChunks":[{"web":{"title":"t"}},{"x":1}]}'))["n_sources"], 1),
    (lambda: scalar.compact_grounding(F.lit("{}"))["n_queries"], 0),
    (lambda: scalar.summary_lines(F.array().cast("array<string>"), F.lit(None).cast("array<string>")), ["Summary pending."]),
    (lambda: scalar.summary_lines(F.array(F.lit("$1. 5 billion")), F.array(F.lit("x"))), ["$1.5 billion"]),
    (lambda: text.span_line(F.lit(3), F.lit("0:00:01"), F.lit("0:00:02"), F.lit(None).cast("string"), F.lit("hi")), "[3] 0:00:01-0:00:02: hi"),
    (lambda: text.transcript_line(F.lit(3), F.lit("0:00:01"), F.lit(""), F.lit("hi")), "[3] [0:00:01] Speaker: hi"),
    (lambda: timeparse.iso_stamp(F.lit("2025-04-23 10:00:00.7").cast("timestamp")), "2025-04-23T10:00:00Z"),
    (lambda: text.unescape_html(F.lit(None).cast("string")), None),
    (lambda: text.name_tokens(F.lit("Ana Lee PhD Jr")), ["ana", "lee", "phd"]),
    (lambda: text.introduced_names(F.lit("Hello I'm Ana O'Lee and so on. My name is Cy Ray from Queens"), ("AND", "FROM")), ["Cy Ray", "Ana Olee"]),
    (lambda: text.name_lines(F.lit("12  Ana Lee -\n x\nWWW.site\n3 Office of Parks\n")), ["Ana Lee", "Office of Parks"]),
    (lambda: text.is_person_name(F.lit("Ana B. Lee, Jr.")), True),
    (lambda: text.is_person_name(F.lit("ANA LEE")), False),
    (lambda: text.is_person_name(F.lit("City of Trees")), False),
    (lambda: text.is_org_line(F.lit("Office of Parks")), True),
    (lambda: text.is_org_line(F.lit("Transcript of the Council")), False),
    (lambda: scalar.reply_text(F.lit('{"choices":[{"message":{"refusal":"no","content":"x"}}]}')), None),
    (lambda: scalar.refusal(F.lit('{"choices":[{"message":{"refusal":"no"}}]}')), "no"),
    (lambda: scalar.reply_text(F.lit('{"choices":[{"message":{"content":["a",{"type":"image"},{"type":"text","text":"b"}]}}]}')), "ab"),
    (lambda: scalar.reply_text(F.lit('{"choices":[{"message":{"content":"(1) is cited"}}]}')), "(1) is cited"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_case(spark, k):
    got = value(spark, CASES[k][0]())
    assert got == (pytest.approx(CASES[k][1]) if isinstance(CASES[k][1], float) else CASES[k][1])


def test_backoff():
    assert [scalar.backoff(k) for k in (0, 3, 9)] == [10, 80, 300] and scalar.backoff(0, retry_after=42) == 42


def test_rounding_is_that_of_the_stored_number(spark):
    import random

    rng = random.Random(5)
    xs = [rng.uniform(-1e5, 1e5) for _ in range(2000)] + [k / 2000 for k in range(-4001, 40001, 2)] + [k / 10000 + 0.0005 for k in range(3000)] + [(2 * k + 1) / 16 for k in range(500)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", scalar.round_seconds(F.col("x")).alias("r")).collect()
    assert [r.x for r in got if r.r != round(r.x, 3)] == []
