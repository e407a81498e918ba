"""Text functions. Columns in, columns out; all of them stay in the JVM."""

from __future__ import annotations

import unicodedata
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Null for null and ''; sources write either for "missing"."""
    return F.nullif(c, F.lit(""))


def first_present(*columns: Column) -> Column:
    """First of the columns that is neither null nor ''."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def clean_text(c: Column) -> Column:
    """White space of any script collapsed to one space and trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def safe_key(c: Column, default: str = "meeting") -> Column:
    plain = F.regexp_replace(c, "[^A-Za-z0-9._-]+", "-")
    return F.coalesce(blank_to_null(F.regexp_replace(plain, "^-+|-+$", "")), F.lit(default))


def slug(c: Column, cap: int | None = None) -> Column:
    """Lower-case words of letters and digits joined by '-'; with ``cap`` cut, and trimmed again."""
    plain = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))
    return plain if cap is None else F.btrim(F.substring(plain, 1, cap), F.lit("-"))


# What is ASCII in each other character's compatibility decomposition.
_FOLDED = {chr(i): unicodedata.normalize("NFKD", chr(i)).encode("ascii", "ignore").decode() for i in range(0x80, 0x110000) if not 0xD800 <= i < 0xE000 and unicodedata.decomposition(chr(i))}
_SINGLE = {c: x for c, x in _FOLDED.items() if len(x) == 1}
_SEVERAL = {c: x for c, x in _FOLDED.items() if len(x) > 1}
_WIDTH = max(map(len, _SEVERAL.values()))


def _ranges(chars: list[str]) -> str:
    """The characters as ranges of a pattern's class. One by one, hundreds of them would be tried for each letter of a text."""
    points = sorted(map(ord, chars))
    firsts = [p for k, p in enumerate(points) if not k or points[k - 1] != p - 1]
    lasts = [p for k, p in enumerate(points) if k + 1 == len(points) or points[k + 1] != p + 1]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(firsts, lasts, strict=True))


_TAKEN_APART = f"[{_ranges(list(_SEVERAL))}]"


def ascii_fold(c: Column) -> Column:
    """Letters without their accents, ligatures and other composed characters as the letters that they stand for,
    other characters outside ASCII dropped: the ASCII of the compatibility decomposition."""
    keys, values = F.lit("".join(_SEVERAL)), F.lit("".join(x.ljust(_WIDTH, "\0") for x in _SEVERAL.values()))

    def spelt(char: Column) -> Column:
        at = F.instr(keys, char)
        return F.when((char > "\x7f") & (at > 0), F.translate(F.substr(values, (at - 1) * _WIDTH + 1, F.lit(_WIDTH)), "\0", "")).otherwise(char)

    plain = F.translate(c, "".join(_SINGLE), "".join(_SINGLE.values()))
    # few texts hold a character that stands for several; only they are taken apart
    several = plain.rlike(r"[^\x00-\x7F]") & plain.rlike(_TAKEN_APART)
    plain = F.when(several, F.array_join(F.transform(F.split(plain, ""), spelt), "")).otherwise(plain)
    return F.regexp_replace(plain, r"[^\x00-\x7F]", "")


def site_slug(c: Column) -> Column:
    """Slug that keeps base letters and spells out '&'."""
    return slug(F.regexp_replace(F.replace(ascii_fold(c), F.lit("&"), F.lit(" and ")), "['’\"]", ""))


def time_slug(c: Column) -> Column:
    """'9:05 AM' becomes '0905-am'; any other text its slug."""
    pattern = r"(?i)^\s*(\d{1,2}):(\d{2})\s*([AP]M)\s*$"
    hour, minute, half = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3))
    return F.when(c.rlike(pattern), F.concat(F.lpad(hour, 2, "0"), minute, F.lit("-"), F.lower(half))).otherwise(slug(c))


# Units after which a split number is a decimal, and the places where one is split.
NUMERIC_UNITS = r"(?:%|(?:percent|billion|million|thousand|trillion|bn|mm?)\b)"
SPLIT_DECIMALS = (r"(?U)(\d)\s+\.(\d)", rf"(?iU)(\d)\.\s+(\d+\s*{NUMERIC_UNITS})", r"(?U)(\d)\.\s+(\d+\.\d)")


def repair_decimals(c: Column) -> Column:
    """Rejoins decimals that speech recognition split ('$1. 5 billion'), until no split one is left. A
    link that is mended can show the next one of its chain of digits and points, so the text is gone over
    as often as its longest chain has points; texts without a chain are not searched again."""

    def mend(text: Column, _: Column) -> Column:
        for pattern in SPLIT_DECIMALS:
            text = F.regexp_replace(text, pattern, "$1.$2")
        return text

    text = F.coalesce(c, F.lit(""))
    chains = F.regexp_extract_all(text, F.lit(r"((?U)\d+(?:\s*\.\s*\d+)+)"))
    links = F.coalesce(F.array_max(F.transform(chains, lambda x: F.length(x) - F.length(F.replace(x, F.lit("."), F.lit(""))))), F.lit(0))
    mended = F.when(links > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(links, F.lit(1))), text, mend)).otherwise(text)
    return F.trim(F.regexp_replace(mended, r"[ \t]+", " "))


def join_tokens(tokens: Column) -> Column:
    """Word tokens as running text: no space before closing marks or after an opening bracket."""
    text = F.array_join(F.filter(tokens, lambda t: F.trim(t) != ""), " ")
    text = F.regexp_replace(text, r"(?U)\s+([,.;:!?%)\]])", "$1")
    text = F.regexp_replace(text, r"(?U)([(\[])\s+", "$1")
    return F.trim(F.regexp_replace(text, r"(?U)\s+('[\p{L}\p{N}_])", "$1"))


def clean_speaker(c: Column) -> Column:
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), "Council Member |Councilmember ", "")
    plain = clean_text(plain)
    return F.when((plain == "") | (F.upper(plain).isin("UNKNOWN", "UNK")), F.lit("UNKNOWN")).otherwise(plain)


def speaker_base_name(c: Column) -> Column:
    """A speaker without group prefix and title."""
    plain = F.regexp_replace(c, r"(?i)^Member\s+of\s+the\s+Public\s*-\s*", "")
    plain = F.regexp_replace(plain, r"(?i)^Council\s+Staff\s*-\s*", "")
    return clean_text(F.regexp_replace(plain, r"(?i)^(Dr|Mr|Ms|Mrs|Mx)\.?\s+", ""))


def name_key(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.lower(speaker_base_name(c)), F.lit("([a-z]+)")), " ")


# Name suffixes that do not tell people apart.
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv")


def name_tokens(c: Column) -> Column:
    words = F.regexp_extract_all(F.lower(ascii_fold(speaker_base_name(c))), F.lit("([a-z0-9]+)"))
    return F.filter(words, lambda t: (F.length(t) > 1) & ~t.isin(*NAME_SUFFIXES))


# Consonant groups of the phonetic code.
SOUND_CODES = {"bfpv": "1", "cgjkqsxz": "2", "dt": "3", "l": "4", "mn": "5", "r": "6"}


def sound_code(c: Column) -> Column:
    """Phonetic code in which every letter without a group, also h and w, separates equal groups."""
    letters = F.regexp_replace(F.lower(ascii_fold(c)), "[^a-z]", "")
    source = "".join(SOUND_CODES)
    digits = F.translate(letters, source, "".join(v * len(k) for k, v in SOUND_CODES.items()))
    digits = F.regexp_replace(digits, "[a-z]", "0")
    runs = F.regexp_replace(digits, r"(\d)\1+", "$1")
    tail = F.replace(F.substr(runs, F.lit(2)), F.lit("0"), F.lit(""))
    return F.when(letters == "", F.lit("")).otherwise(F.rpad(F.concat(F.upper(F.substring(letters, 1, 1)), tail), 4, "0"))


# Words that an organisation follows, and those that a speaker's name follows.
ROLE_PLACES = r"(?i)\b(?:from|with|at|representing|on behalf of)\s+([^.;:]{3,100})"
ROLE_TITLES = r"(?i)\b(?:director|president|chair|commissioner|counsel|attorney)\s+(?:of|for|at)\s+([^.;:]{3,100})"
INTRODUCTIONS = {
    "named": r"MY NAME IS\s+[A-Z]",
    "two words": r"I(?:'M| AM)\s+[A-Z][A-Z'.-]+\s+[A-Z][A-Z'.-]+",
    "place": r"(?:FROM|REPRESENTING|ON BEHALF OF)\s+[A-Z]",
}
INTRODUCED = (
    r"\bMY NAME IS\s+([A-Z][A-Z'.-]*(?:\s+[A-Z][A-Z'.-]*){0,4})",
    r"\b(?:HI|HELLO|GOOD MORNING|THANK YOU)\.?\s+I'M\s+([A-Z][A-Z'.-]*(?:\s+[A-Z][A-Z'.-]*){1,4})",
)


def role_hint(speaker: Column, text: Column) -> Column:
    """Organisation named after words like 'from' or 'director of', else what follows ' - '."""
    told = [blank_to_null(clean_text(F.regexp_extract(text, pattern, 1))) for pattern in (ROLE_PLACES, ROLE_TITLES)]
    tail = F.when(F.contains(speaker, F.lit(" - ")), F.regexp_replace(speaker, "^.*? - ", "")).otherwise("")
    return F.substring(F.coalesce(*told, tail), 1, 120)


def is_introduction(text: Column) -> Column:
    return F.upper(text).rlike(r"\b(?:" + "|".join(INTRODUCTIONS.values()) + ")")


def mentions_name(text: Column, name: Column) -> Column:
    """The name's last word of more than two letters is a word of the text."""
    words = lambda c: F.regexp_extract_all(F.upper(c), F.lit("([A-Z][A-Z'.-]*)"))
    last = F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.filter(words(name), lambda t: F.length(t) > 2)), -1)
    return F.coalesce(F.array_contains(words(text), last), F.lit(False))


def introduced_names(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """Names that speakers of the text give for themselves, capitalised: those of the first form of words in
    order, then those of the second. A name is up to four words before the first stop word (upper case), none of fewer than two."""

    def name(found: Column) -> Column:
        words = F.transform(F.split(found, r"\s+"), lambda w: F.replace(F.regexp_replace(w, "^['.-]+|['.-]+$", ""), F.lit("'"), F.lit("")))
        stop = F.array_position(F.transform(words, lambda w: w.isin(*stop_words) if stop_words else F.lit(False)), True)
        kept = F.slice(words, F.lit(1), F.least(F.when(stop > 0, stop - 1).otherwise(F.size(words)), F.lit(4)).cast("int"))
        return F.when(F.size(kept) >= 2, F.initcap(F.array_join(kept, " ")))

    found = F.concat(*[F.regexp_extract_all(F.upper(text), F.lit(form), F.lit(1)) for form in INTRODUCED])
    return F.array_compact(F.transform(found, name))


# Lines of a transcript's title pages that are no names, and words of organisations.
NO_NAME_LINES = ("world wide dictation", "phone:", "www.", "start:", "recess:")
NO_PERSON_WORDS = ("committee", "council", "city of", "held at", "transcript")
NO_ORG_WORDS = ("transcript of", "city of new york", "held at")
ORG_WORDS = (
    "administration", "agency", "alliance", "association", "authority", "board", "bureau", "charities", "coalition", "commission",
    "committee", "council", "department", "foundation", "hospital", "initiative", "office", "plans", "project", "services",
)


def _has_any(c: Column, words: tuple[str, ...]) -> Column:
    low = F.lower(c)
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(low, w))


def name_lines(text: Column) -> Column:
    """Lines of a title page without line numbers, blanks and contact details."""
    lines = F.transform(F.split(text, r"\r\n|[\n\r]"), lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"^\s*\d+\s+", ""), r"\s+", " "), "^[ -]+|[ -]+$", ""))
    return F.filter(lines, lambda x: (F.length(x) >= 3) & ~_has_any(x, NO_NAME_LINES))


def is_person_name(line: Column) -> Column:
    """Two to five capitalised words, also with Jr. at the end, in mixed case and without an office's words."""
    shape = line.rlike(r"^[A-Z][A-Za-z'.-]+(?:\s+[A-Z][A-Za-z'.-]+|,\s*Jr\.?|\s+Jr\.?)+$")
    return F.coalesce(shape & (F.upper(line) != line) & F.size(name_tokens(line)).between(2, 5) & ~_has_any(line, NO_PERSON_WORDS), F.lit(False))


def is_org_line(line: Column) -> Column:
    """Two to twelve words, one of which tells an organisation."""
    return F.coalesce(_has_any(line, ORG_WORDS) & ~_has_any(line, NO_ORG_WORDS) & F.size(name_tokens(line)).between(2, 12), F.lit(False))


# Words for the numbers of agenda items.
NUMBER_WORDS = dict(zip("one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split(), range(1, 21), strict=True))
AGENDA_ITEM = r"(?i)^\s*(Resolution|Introduction|Intro|LU|Land Use(?: Item)?)\s+([0-9]+[A-Z]?(?:-[A-Z])?|" + "|".join(NUMBER_WORDS) + r")\b"


def agenda_label(text: Column) -> Column:
    """'Intro twelve ...' becomes 'Introduction 12'; null for other texts."""
    kind, number = F.initcap(F.regexp_extract(text, AGENDA_ITEM, 1)), F.regexp_extract(text, AGENDA_ITEM, 2)
    kind = F.when(kind == "Intro", "Introduction").when(kind.startswith("Lu"), "LU").otherwise(kind)
    words = F.create_map(*[F.lit(x) for k, v in NUMBER_WORDS.items() for x in (k, str(v))])
    return F.when(text.rlike(AGENDA_ITEM), F.concat_ws(" ", kind, F.coalesce(F.element_at(words, F.lower(number)), F.upper(number))))


def agenda_topic(text: Column, cap: int = 12) -> Column:
    rest = F.regexp_replace(F.regexp_replace(text, AGENDA_ITEM, ""), r"^[ .:-]+|[ .:-]+$", "")
    rest = F.regexp_replace(rest, r"(?i)^(calls on|calls for|calls upon|would|approves?|authorizes?)\s+", "")
    rest = F.regexp_replace(clean_text(rest), r"[ .]+$", "")
    words = F.split(rest, " ")
    short = F.concat(F.regexp_replace(F.array_join(F.slice(words, 1, cap), " "), "[,;:]+$", ""), F.lit("..."))
    return F.when(F.size(words) > cap, short).otherwise(rest)


def vote_title(text: Column) -> Column:
    """Title of a voice vote on an agenda item; null where no item begins."""
    item, topic = agenda_label(text), blank_to_null(agenda_topic(text))
    return F.concat(F.lit("Voice Vote on "), item, F.coalesce(F.concat(F.lit(": "), topic), F.lit("")))


def vote_summary(text: Column) -> Column:
    item, topic = agenda_label(text), blank_to_null(agenda_topic(text))
    return F.concat(F.lit("The Council took a voice vote on "), item, F.coalesce(F.concat(F.lit(", concerning "), topic), F.lit("")), F.lit(". The ayes had it and the item was adopted."))


def type_token(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(c), r"[\s-]+", "_"))


def bias_term(c: Column) -> Column:
    """A term as speech services take it: hyphens for spaces, no commas."""
    plain = F.regexp_replace(clean_text(c), "^[ ,;:]+|[ ,;:]+$", "")
    plain = F.regexp_replace(F.regexp_replace(F.replace(plain, F.lit(","), F.lit("")), r"\s+", "-"), "-{2,}", "-")
    return F.regexp_replace(plain, "^[-;:]+|[-;:]+$", "")


def name_variants(c: Column) -> Column:
    """A name, without periods, without initials, and without a suffix; each once, in this order."""
    base = F.regexp_replace(clean_text(c), "^[ ,;:]+|[ ,;:]+$", "")
    bare = F.regexp_replace(base, r"\s+[A-Z]\.(?=\s)", " ")
    out = F.array(base, F.replace(base, F.lit("."), F.lit("")), clean_text(bare), F.regexp_replace(clean_text(bare), r"(?i),?\s+Jr\.?$", ""))
    return F.array_distinct(F.filter(out, lambda t: t != ""))


def clip(c: Column, width: int) -> Column:
    return F.when(F.length(c) > width, F.concat(F.rtrim(F.substring(c, 1, width - 1)), F.lit("…"))).otherwise(c)


def fixed_width(c: Column, width: int) -> Column:
    return F.rpad(clip(F.coalesce(clean_text(c), F.lit("")), width), width, " ")


def source_label(*columns: Column) -> Column:
    """First usable speaker label of a vendor's record, with '_' for white space; UNKNOWN counts as none."""
    each = [F.when(F.upper(F.trim(c)).isin("UNKNOWN", "UNK", ""), None).otherwise(F.regexp_replace(F.trim(c), r"\s+", "_")) for c in columns]
    return F.coalesce(*each)


def redact_key(url: Column) -> Column:
    return F.regexp_replace(url, r"([?&]key=)[^&\s]+", "$1[redacted]")


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'))


#: Characters of each entity name of HTML 5; a name without a semicolon also stands at the start of a longer word.
ENTITIES = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
OPEN_ENTITIES = sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
#: What a number from 128 to 159 stands for: the character of code page 1252 at that place, where it has one.
CODE_PAGE = "".join(bytes([i]).decode("cp1252", "replace").replace("\ufffd", chr(i)) for i in range(0x80, 0xA0))


def unescape_html(c: Column) -> Column:
    """Entities by name, decimal and hexadecimal number become their characters, as HTML 5 has it: names with and some
    without a semicolon, numbers up to the first other sign, and numbers that are no character by their substitute
    or by nothing; anything else stays. What an entity gives is not read again, so '&amp;lt;' becomes '&lt;'."""
    usual = {k: v for k, v in ENTITIES.items() if k in name2codepoint or k == "apos"}
    table = lambda names: F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    known, rare, opened = table(usual), table({k: v for k, v in ENTITIES.items() if k not in usual}), table({k: html5[k] for k in OPEN_ENTITIES})
    numeric, closed, begun = r"^(?:#([0-9]+)|#[xX]([0-9a-fA-F]+));?", "^([A-Za-z][A-Za-z0-9]*);", "^(" + "|".join(OPEN_ENTITIES) + ")"

    def one(piece: Column) -> Column:
        decimal, hexadecimal = F.regexp_extract(piece, numeric, 1), F.regexp_extract(piece, numeric, 2)
        # leading zeros say nothing, and nine digits are more than any character has
        short = F.substring(F.regexp_replace(F.when(decimal != "", decimal).otherwise(hexadecimal), "^0+(?=.)", ""), 1, 9)
        number = F.when(decimal != "", short).otherwise(F.conv(short, 16, 10)).try_cast("long")
        nothing = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
        char = (
            F.when(number.between(128, 159), F.substr(F.lit(CODE_PAGE), (number - 127).cast("int"), F.lit(1)))
            .when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), "\ufffd")
            .when(nothing, "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        )
        code = F.regexp_extract(piece, closed, 1)
        named, start = F.coalesce(F.element_at(known, code), F.element_at(rare, code)), F.regexp_extract(piece, begun, 1)
        after = lambda n: F.substr(piece, n + 1)
        return (
            F.when(piece.rlike(numeric), F.concat(char, F.regexp_replace(piece, numeric, "")))
            .when((code != "") & named.isNotNull(), F.concat(named, after(F.length(code) + 1)))
            .when(start != "", F.concat(F.element_at(opened, start), after(F.length(start))))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    pieces = F.split(c, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), one)
    return F.when(F.contains(c, F.lit("&")), F.concat(F.element_at(pieces, 1), F.array_join(rest, ""))).otherwise(c)


def base64_url(c: Column) -> Column:
    """Text of a base64 value as found in links: percent signs and entities undone, padding optional;
    null where it is none."""
    plain = F.translate(F.regexp_replace(unescape_html(F.try_url_decode(c)), r"\s+|=+$", ""), "-_", "+/")
    padded = F.rpad(plain, (F.ceil(F.length(plain) / 4) * 4).cast("int"), F.lit("="))
    return F.try_to_binary(padded, F.lit("base64")).cast("string")


def file_stem(url: Column) -> Column:
    """Name of a recording in a URL or path, without folders, query and ending."""
    name = F.element_at(F.split(F.regexp_replace(url, r"[?#].*$", ""), "/"), -1)
    return F.regexp_replace(name, r"(?i)\.(mp4|m4a|mp3|vtt)$", "")


def room_prefix(name: Column) -> Column:
    return F.regexp_replace(file_stem(name), r"_\d{6}-\d{6}.*$", "")


# The council's name, and the places and bodies that mean it.
COUNCIL_BODY = "New York City Council"
COUNCIL_PLACES = ("council chambers", "committee room", "city hall", "250 broadway")
COUNCIL_NAMES = r"(?i)^(?:(?:new york )?city council|committee on .*|subcommittee on .*)$"


def site_body(location: Column, *names: Column) -> Column:
    """The body that a meeting is shown under: the council for its rooms and committees and where no name is
    given, else the first name given."""
    body = F.coalesce(blank_to_null(F.trim(first_present(*names))), F.lit(COUNCIL_BODY))
    return F.when(_has_any(F.coalesce(location, F.lit("")), COUNCIL_PLACES) | body.rlike(COUNCIL_NAMES), F.lit(COUNCIL_BODY)).otherwise(body)


def meeting_title(kind: Column, *names: Column) -> Column:
    body = F.coalesce(blank_to_null(F.trim(first_present(*names))), F.lit("Meeting"))
    stated = F.contains(F.lower(body), F.lit("stated")) | (F.lower(body) == "city council") | F.coalesce(kind == "STATED_MEETING", F.lit(False))
    return F.when(stated, F.lit("Stated Meeting")).otherwise(body)


def transcript_line(index: Column, clock: Column, speaker: Column, text: Column) -> Column:
    """A row of a transcript; a row without a speaker is anybody's."""
    return F.format_string("[%d] [%s] %s: %s", index.cast("long"), clock, F.coalesce(blank_to_null(speaker), F.lit("Speaker")), clean_text(text))


def span_line(index: Column, start: Column, end: Column, label: Column, text: Column) -> Column:
    """A row with both its clocks, and its label where it has one."""
    named = F.when(blank_to_null(label).isNotNull(), F.concat(F.lit(" "), label, F.lit(":"))).otherwise("")
    return F.format_string("[%d] %s-%s:%s %s", index.cast("long"), start, end, named, F.coalesce(text, F.lit("")))


def caption_line(clock: Column, text: Column) -> Column:
    return F.format_string("[%s] %s", clock, F.coalesce(text, F.lit("")))


def styled_speaker(original: Column, name: Column) -> Column:
    """A corrected name that keeps the prefix of the original."""
    plain = clean_text(name)
    staff = original.rlike(r"(?i)^Council\s+Staff\s*-")
    public = original.rlike(r"(?i)^Member\s+of\s+the\s+Public\s*-")
    return F.when(staff, F.concat(F.lit("Council Staff - "), plain)).when(public, F.concat(F.lit("Member of the Public - "), plain)).otherwise(plain)


def mapped_speaker(name: Column, role: Column) -> Column:
    plain = clean_speaker(name)
    public = F.lower(role).rlike("member of the public|public witness|testifier")
    keep = (plain == "UNKNOWN") | plain.rlike(r"(?i)^Member\s+of\s+the\s+Public\s*-")
    return F.when(keep | ~F.coalesce(public, F.lit(False)), plain).otherwise(F.concat(F.lit("Member of the Public - "), plain))
