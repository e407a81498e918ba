"""Chat formatting with a grammar round trip, in DataFrame functions only.

A conversation is rendered as, for each turn, ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. A fixed parser
reads the rendered text back. Where what it recovers differs from the source, the conversation is
rendered again with its conflicting content escaped, and the round trip is checked again.

Escaping is reversible: inside texts ``<`` + n backslashes + ``|`` gets one backslash more, so no ``<|``
is left; in roles a backslash is doubled first and a line feed written ``\\n``. The parser undoes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape_text(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # pairs of backslashes are set apart first, so that \\n is not read as an escaped line feed
    halves = F.split(unescape_text(role), r"\\\\")
    return F.array_join(F.transform(halves, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def render(turns: Column, escaped: bool) -> Column:
    def one(t: Column) -> Column:
        role = escape_role(t.role) if escaped else t.role
        text = escape_text(t.text) if escaped else t.text
        return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))

    return F.array_join(F.transform(turns, one), "")


def parse(rendered: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation; anything outside the grammar is null,
    and so differs from every source, which is how a conflict shows.

    A turn ends at its first control string, which must be ``<|im_end|>`` with a line feed and the next
    turn or the end behind it: no ``<|`` is part of a role or text. A role's backslashes are pairs or ``\\n``.
    """
    pieces = F.split(rendered, r"<\|im_start\|>")

    def one(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        role = F.when(cut > 0, F.substring(piece, 1, cut - 1))
        plain = unescape_text(role)
        loose = F.replace(F.replace(plain, F.lit("\\\\"), F.lit("")), F.lit("\\n"), F.lit("")).contains("\\")
        rest = F.substr(piece, cut + 1)
        text = F.when(rest.endswith(END + "\n"), F.substring(rest, F.lit(1), F.length(rest) - (len(END) + 1)))
        return F.struct(
            F.when(~role.contains("<|") & ~loose, unescape_role(role)).alias("role"),
            F.when(~text.contains("<|"), unescape_text(text)).alias("text"),
        )

    turns = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), one)
    return F.when(F.element_at(pieces, 1) == "", turns)


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; other columns are ignored).

    Returns conv_id, turns (the source), formatted, recovered (parsed back), was_escaped, loss_text
    (assistant texts, the text under the loss mask, one after the other).

    Null roles and texts count as empty. Turns that tie in ``turn`` are ordered by role, then text, and
    repeated rows are repeated turns. Rows of a null conv_id form one conversation. An empty table
    gives an empty result. A conversation is one string and so must fit in a row. A round trip that
    still fails after escaping stops the job rather than pass a damaged text on.
    """
    own = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    per = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("all"))
    per = per.select("conv_id", F.transform("all", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))
    # decide by round trip: the plain text where it reads back the same, else the escaped one
    per = per.withColumn("plain", render(F.col("turns"), escaped=False))
    per = per.withColumn("was_escaped", ~parse(F.col("plain")).eqNullSafe(F.col("turns")))
    per = per.withColumn("formatted", F.when(F.col("was_escaped"), render(F.col("turns"), escaped=True)).otherwise(F.col("plain")))
    per = per.withColumn("recovered", parse(F.col("formatted")))
    checked = F.when(F.col("recovered").eqNullSafe(F.col("turns")), F.col("recovered")).otherwise(
        F.raise_error(F.concat(F.lit("chat round trip failed for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    )
    per = per.withColumn("recovered", checked)
    loss = F.array_join(F.transform(F.filter("recovered", lambda t: t.role == "assistant"), lambda t: t.text), "")
    return per.select("conv_id", "turns", "formatted", "recovered", "was_escaped", loss.alias("loss_text"))


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and hashes of what was read back from the formatted text."""
    whole = F.array_join(F.transform("recovered", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return formatted.select(
        "conv_id",
        F.size("recovered").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
