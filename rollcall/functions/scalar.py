"""Numbers, JSON values, hashes and classifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.text import blank_to_null, repair_decimals


def round_seconds(c: Column) -> Column:
    """Three decimals of the number as it is stored, which need not be the one that is shown: 1.0005 is stored
    a little lower and gives 1.0. Ties go to the even digit; null counts as 0.

    The number is split in two parts short enough that 2000 times each is exact, so its distance from the
    middle between two results has the right sign.
    """
    x = F.coalesce(c.cast("double"), F.lit(0.0))
    below = F.floor(x * 1000).cast("double")
    head = x.cast("float").cast("double")
    beyond = (head * 2000 - (below * 2 + 1)) + (x - head) * 2000
    up = (beyond > 0) | ((beyond == 0) & (below % 2 != 0))
    return F.when(F.isnan(x) | (F.abs(x) > 1e12), x).otherwise((below + F.when(up, 1.0).otherwise(0.0)) / 1000)


# Scores of confidence words.
CONFIDENCE_WORDS = {"very high": 0.9, "high": 0.9, "certain": 0.9, "medium": 0.65, "moderate": 0.65, "low": 0.35, "weak": 0.35, "unknown": 0.2, "missing": 0.2, "none": 0.2}


def confidence(c: Column) -> Column:
    """A number clamped to [0, 1], a known word's score, else 0.5."""
    word, number = F.lower(F.trim(c.cast("string"))), c.cast("string").try_cast("double")
    known = F.create_map(*[F.lit(x) for pair in CONFIDENCE_WORDS.items() for x in pair])
    clamped = F.when(number.isNotNull(), round_seconds(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number))))
    return F.coalesce(clamped, F.element_at(known, word), F.lit(0.5))


def token_estimate(text: Column, characters: int) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / characters)).cast("long")


def chapter_floor(kind: Column, seconds: Column) -> Column:
    """Fewest chapters expected of a meeting of this kind and length; 0 if none are."""
    hours = seconds / 3600
    stated = F.when(seconds >= 3600, F.greatest(F.lit(35.0), F.bround(30 * hours)))
    return F.coalesce(F.when(kind == "HEARING", F.greatest(F.lit(12.0), F.bround(20 * hours))).when(kind == "STATED_MEETING", stated), F.lit(0.0)).cast("int")


def vendor_cost(seconds: Column, per_hour: Column) -> Column:
    return seconds / 3600 * per_hour


def within_budget(cost: Column, budget: float) -> Column:
    """The cost, or an error that stops the job."""
    return F.when(cost <= budget, cost).otherwise(F.raise_error(F.format_string("cost %.2f is over the budget", cost)).cast("double"))


def milliseconds(c: Column) -> Column:
    return c.cast("string").try_cast("double") / 1000


def real_time_factor(wall: Column, duration: Column) -> Column:
    return F.when(duration > 0, F.round(wall / duration, 4))


def backoff(attempt: int, base: float = 10.0, most: float = 300.0, retry_after: float = 0.0) -> float:
    """Seconds to wait before an attempt (from 0)."""
    return max(min(most, base * 2**attempt), retry_after)


# Classifications. The sources' three rule sets differ and stay apart.
LAND_USE_TERMS = ("land use", "zoning", "franchises", "landmarks", "public siting")


def meeting_type_from_event(body: Column, *status: Column) -> Column:
    text = F.lower(F.concat_ws(" ", body, *status))
    return (
        F.when((F.lower(F.trim(body)) == "city council") | F.contains(text, F.lit("stated meeting")), "STATED_MEETING")
        .when(text.rlike("|".join(LAND_USE_TERMS)), "LAND_USE")
        .when(text.rlike("vote|voting"), "VOTE")
        .otherwise("HEARING")
    )


def meeting_type_from_document(known: Column, *texts: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *texts))
    found = F.when(F.contains(text, F.lit("stated")), "STATED_MEETING").when(F.contains(text, F.lit("land use")), "LAND_USE").when(F.contains(text, F.lit("vote")), "VOTE")
    return F.coalesce(F.when(known.isin("STATED_MEETING", "LAND_USE", "VOTE", "HEARING"), known), found, F.lit("HEARING"))


VOTE_TYPES = ("VOTE", "VOICE_VOTE", "ROLL_CALL", "VOTE_OUTCOME")


def tags_from_chapters(types: Column, kind: Column) -> Column:
    vote = F.exists(types, lambda t: t.isin(*VOTE_TYPES))
    return F.array_distinct(F.array_compact(F.array(kind, F.when(vote, F.lit("VOTE")))))


# Chapter types.
CHAPTER_TYPES = ("PROCEDURE", "ROLL_CALL", "REMARKS", "TESTIMONY", "QUESTION", "DEBATE", "VOTE", "VOICE_VOTE", "VOTE_OUTCOME", "PRESENTATION", "RECESS")


def chapter_type(c: Column) -> Column:
    plain = F.upper(F.regexp_replace(F.trim(c), r"[\s-]+", "_"))
    return F.when(plain.isin(*CHAPTER_TYPES), plain).otherwise("REMARKS")


def known_tags(tags: Column, known: Sequence[str] = ("STATED_MEETING", "LAND_USE", "VOTE", "HEARING")) -> Column:
    return F.filter(tags, lambda t: t.isin(*known))


# Openings of agenda items that say nothing about the subject.
TOPIC_JUNK = (r"^agenda\b", r"^see\s", "^roll call", r"^\d", "meeting details to be determined", r"^(communication|introduction)s?\s+(from|and)\b")


def event_topic(matter: Column, title: Column, body: Column) -> Column:
    """Subject of an event's first item; null for boilerplate, short texts and the body's own name."""
    lines = F.filter(F.transform(F.split(F.coalesce(title, F.lit("")), r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    text = F.coalesce(blank_to_null(F.trim(matter)), F.array_join(F.slice(lines, 1, 3), " "))
    text = F.regexp_replace(F.regexp_replace(text, r"\s+", " "), r"\.+$", "")
    junk = text.rlike("(?i)" + "|".join(TOPIC_JUNK)) | (F.length(text) < 8) | F.lower(text).eqNullSafe(F.lower(F.trim(body)))
    return F.when(~junk, text)


# JSON and hashes


def json_text(text: Column) -> Column:
    """The JSON of a reply: without a code fence; where that cannot be read, from its first brace or bracket to
    the last one, without commas before closing ones, if that can be read."""
    plain = F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", "")
    inner = F.regexp_replace(F.regexp_extract(plain, r"(?s)([{\[].*[}\]])", 1), r",(\s*[}\]])", "$1")
    bad = F.try_parse_json(plain).isNull() & F.try_parse_json(blank_to_null(inner)).isNotNull()
    return F.when(bad, inner).otherwise(plain)


def json_object(text: Column, schema: T.DataType | str) -> Column:
    """A JSON reply, also inside a code fence or other words; null if it cannot be read."""
    return F.from_json(json_text(text), schema, {"mode": "PERMISSIVE"})


def usable(text: Column, items: str, may_be_empty: bool = False, **wanted: str) -> Column:
    """Whether an artifact can stand for its stage's work: JSON that can be read whole, with a list in ``items``
    (not empty unless it may be) and the wanted values of other fields."""
    listed = F.from_json(F.get_json_object(text, f"$.{items}"), "array<string>")
    good = F.try_parse_json(blank_to_null(text)).isNotNull() & (F.size(listed) >= (0 if may_be_empty else 1))
    for name, value in wanted.items():
        good = good & (F.get_json_object(text, f"$.{name}") == value)
    return F.coalesce(good, F.lit(False))


def compact_grounding(text: Column, most: int = 40) -> Column:
    """What is kept of a model's search record: its queries that are not blank, title and address of its first
    ``most`` web sources, and the number of each in all."""
    r = F.from_json(text, "struct<webSearchQueries: array<string>, groundingChunks: array<struct<web: struct<title: string, uri: string>>>>")
    none = F.array().cast("array<string>")
    queries = F.filter(F.coalesce(r["webSearchQueries"], none), lambda q: F.trim(q) != "")
    web = F.array_compact(F.transform(F.coalesce(r["groundingChunks"], F.array().cast("array<struct<web:struct<title:string,uri:string>>>")), lambda x: x["web"]))
    return F.struct(queries.alias("queries"), F.size(queries).alias("n_queries"), F.slice(web, 1, most).alias("sources"), F.size(web).alias("n_sources"))


def json_first(text: Column, *paths: str) -> Column:
    """First non-empty value of alternative paths."""
    return F.coalesce(*[blank_to_null(F.get_json_object(text, p)) for p in paths])


def json_rows(text: Column, schema: str) -> Column:
    """An array of objects, whether given bare, alone, or as a list of one list."""
    return F.coalesce(F.from_json(text, f"array<{schema}>"), F.array(F.from_json(text, schema)))


def content_version(*columns: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the values in this order."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]), 256), 1, 16)


def params_hash(**params: Column) -> Column:
    """SHA-256 of the JSON of the parameters, sorted by name."""
    return F.sha2(F.to_json(F.struct(*[params[k].alias(k) for k in sorted(params)])), 256)


def reply_text(body: Column) -> Column:
    """Text of a model's reply: a tool call's arguments, else a list of text parts, bare strings among them, or
    plain content. A refusal and a reply without text are null; ``refusal`` tells them apart."""
    message = "$.choices[0].message"
    content = F.get_json_object(body, f"{message}.content")
    part = lambda p: F.when(p.rlike(r"^\s*\{"), F.when(F.coalesce(F.get_json_object(p, "$.type"), F.lit("text")) == "text", F.get_json_object(p, "$.text"))).otherwise(p)
    parts = F.transform(F.from_json(content, "array<string>"), part)
    plain = F.when(content.rlike(r"^\s*\["), F.array_join(F.array_compact(parts), "")).otherwise(content)
    return F.coalesce(
        blank_to_null(F.get_json_object(body, f"{message}.tool_calls[0].function.arguments")),
        F.when(refusal(body).isNull(), blank_to_null(plain)),
    )


def refusal(body: Column) -> Column:
    """Why the model gave no reply; null if it gave one."""
    return blank_to_null(F.get_json_object(body, "$.choices[0].message.refusal"))


def cached_tokens(usage: Column) -> Column:
    paths = ("$.prompt_tokens_details.cached_tokens", "$.cached_tokens", "$.cached_content_token_count")
    return F.coalesce(*[F.get_json_object(usage, p).try_cast("long") for p in paths], F.lit(0))


def default_list(values: Column, fallback: Column) -> Column:
    """The list, or the fallback where it is null or empty."""
    return F.when(F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0, values).otherwise(fallback)


def summary_lines(derived: Column, given: Column) -> Column:
    """Lines of the derived summary, else of the given one, else one that says that there is none yet."""
    lines = default_list(default_list(derived, given), F.array(F.lit("Summary pending.")))
    return F.transform(lines, repair_decimals)
