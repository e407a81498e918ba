"""Text and date functions against what Python's own library gives, over written lists and random characters."""

import html
import random
import unicodedata
from email.utils import parsedate_to_datetime
from html.entities import html5

from pyspark.sql import functions as F

from rollcall.functions import scalar, text, timeparse


def applied(spark, function, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string").select("i", function(F.col("t")).alias("x")).collect()
    return [r.x for r in sorted(rows)]


def test_ascii_fold(spark):
    rng, points = random.Random(4), [i for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    values = ["Nguyễn Tiến", "Đặng", "ﬁnance", "ＡＢＣ １２", "½ cup", "𝐀𝐁", "Å Å", ""]
    values += ["".join(chr(rng.choice(points[: 0x3000 if rng.random() < 0.7 else None])) for _ in range(8)) for _ in range(1000)]
    values += [chr(i) for i in points if unicodedata.decomposition(chr(i))][::7]
    assert applied(spark, text.ascii_fold, values) == [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values]


def test_ascii_fold_tries_few_ranges(spark):
    """Each letter of a text is tried against each part of a pattern's class."""
    plan = spark.createDataFrame([("½ – é",)], "t string").select(text.ascii_fold(F.col("t")).alias("x"))
    assert 0 < plan._jdf.queryExecution().analyzed().toString().count("\\x{") < 150 and plan.first().x == "12  e"


def test_unescape_html(spark):
    rng, names = random.Random(5), list(html5)
    values = ["&lbrace;", "&nbspb", "&copy 2020", "&#150;", "&notit; &not; &ampx", "&#x110000;&#0;&#xD800;&#128;&#129;&#13;&#65", "&#99999999999999999;", "&&amp;&", "a &x; &hellip", "&AMP&lt;&LT", "&NotEqualTilde;", "&#x;", "&#;"]
    number = lambda: rng.choice([rng.randrange(300), rng.randrange(0x111000)])
    pieces = [lambda: "&" + rng.choice(names), lambda: f"&#{number()}" + rng.choice(["", ";"]), lambda: f"&#{rng.choice('xX')}{number():x}" + rng.choice(["", ";", " "]), lambda: rng.choice(["a", "; ", "&", "not", "1"])]
    values += ["".join(rng.choice(pieces)() for _ in range(rng.randrange(1, 6))) for _ in range(1500)]
    assert applied(spark, text.unescape_html, values) == [html.unescape(v) for v in values]


def test_mail_date(spark):
    def plain(value):
        try:
            return parsedate_to_datetime(value).isoformat()
        except (TypeError, ValueError):
            return value.strip()

    values = [
        "Wed, 23 Apr 2025 18:42:00 GMT", "Wed, 23 Apr 2025 10:00:00 EST", "23 Apr 25 10:00 -0400", "Mon, 5 May 99 1:02 PDT", " some day ", "Tue, 31 Feb 2025 10:00:00 GMT", "Tue, 1 Feb 2025 25:00:00 GMT",
        "Wed, 23 Apr 2025 18:42:00", "Wed, 23 Apr 2025 18:42:00 -0000", "Wed, 23 April 2025 18:42:00 +0530", "23-Apr-2025 18:42:00 XYZ", "Wed, 3 Sep 68 10:00:00 MST", "Fri,4 Jul 2025 08:09 z", "Wed, 23 Apr 2025 22:00:00 -0400",
    ]
    assert applied(spark, timeparse.mail_date, values) == [plain(v) for v in values]


def test_confidence_rounds_the_stored_number(spark):
    rng = random.Random(6)
    values = ["0.1235", "0.0005", "0.9995", "0.6785", "1.5", "-3"] + [repr(rng.random()) for _ in range(300)] + [f"{rng.random():.4f}" for _ in range(1000)]
    assert applied(spark, scalar.confidence, values) == [round(max(0, min(1, float(v))), 3) for v in values]


def test_white_space_of_any_script_splits_decimals(spark):
    assert applied(spark, text.repair_decimals, ["costs $1. 5 billion", "1 .5", "2. 3 percent"]) == ["costs $1.5 billion", "1.5", "2.3 percent"]


def test_votes(spark):
    said = ["Resolution twelve would name a street. ", "Intro 4-A.", "good morning"]
    assert applied(spark, text.vote_title, said) == ["Voice Vote on Resolution 12: name a street", "Voice Vote on Introduction 4-A", None]
    assert applied(spark, text.vote_summary, said)[0] == "The Council took a voice vote on Resolution 12, concerning name a street. The ayes had it and the item was adopted."
    assert applied(spark, text.vote_summary, said)[1:] == ["The Council took a voice vote on Introduction 4-A. The ayes had it and the item was adopted.", None]


def test_names_of_the_first_form_come_first(spark):
    assert applied(spark, lambda c: text.introduced_names(c), ["Hello I'm Ana Lee, hi. My name is Cy Ray"]) == [["Cy Ray", "Ana Lee"]]
