"""Repair of broken JSON: one pass over the text that takes what a model meant.

Bare keys and words, single quotes, quotes within words, comments, missing commas, commas too many and missing
closing signs are read as such; what stands before the first value and behind it is left out.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.scalar import json_text

_QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’"}
_WORDS = {"true": True, "false": False, "null": None, "none": None}
_NUMBER = re.compile(r"-?\d+(\.\d+)?([eE][+-]?\d+)?")
_KEY = re.compile(r"""\s*["'“‘][^"'”’\n]{0,100}["'”’]\s*:""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


class Tolerant:
    """Reads the first value of a text. A value is an object, a list, a string, a number or a word."""

    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def peek(self) -> str:
        """The next sign that is neither white space nor in a comment; '' at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at].isspace():
                self.at += 1
            if self.text.startswith(("//", "# "), self.at):
                self.at = (self.text.find("\n", self.at) + 1) or len(self.text)
            elif self.text.startswith("/*", self.at):
                self.at = (self.text.find("*/", self.at + 2) + 2) if "*/" in self.text[self.at + 2 :] else len(self.text)
            else:
                return self.text[self.at : self.at + 1]

    def value(self, ends: str):
        sign = self.peek()
        if sign in ("{", "["):
            self.at += 1
            return self.members() if sign == "{" else self.items()
        return self.string(ends) if sign in _QUOTES else self.word(ends)

    def members(self) -> dict:
        out: dict = {}
        while (sign := self.peek()) not in ("", "}"):
            if sign in ",:;":
                self.at += 1
                continue
            if sign == "]":  # a closing sign of another kind: the object was not closed
                return out
            key = self.string(":") if sign in _QUOTES else self.word(":,}")
            if self.peek() == ":":
                self.at += 1
                out[str(key)] = None if self.peek() in ("", ",", "}") else self.value(",}")
            elif key != "":
                out[str(key)] = None
        self.at += 1
        return out

    def items(self) -> list:
        out = []
        while (sign := self.peek()) not in ("", "]"):
            if sign in ",;":
                self.at += 1
            elif sign in "}:":
                return out
            else:
                out.append(self.value(",]"))
        self.at += 1
        return out

    def closes(self, at: int, ends: str) -> bool:
        """Whether a quote before ``at`` ends its string: what follows is a sign that may, or the end."""
        rest = self.text[at:].lstrip(" \t\r\n") if at < len(self.text) else ""
        if not rest or rest[0] in ends or rest[0] in "}]":
            # a comma within a sentence is followed by a word, one between members by a key or a value
            return not (rest[:1] == "," and "}" in ends and not re.match(r""",\s*(["'“‘}\]]|\w+["']?\s*:|$|//|/\*)""", rest))
        between = self.text[at : len(self.text) - len(rest)]
        # a comma is missing: a key comes next, or a string on a line of its own
        return rest[0] in _QUOTES and bool(between) and ("\n" in between or "}" in ends and bool(_KEY.match(rest)))

    def string(self, ends: str) -> str:
        close = _QUOTES[self.text[self.at]]
        self.at += 1
        out: list[str] = []
        while self.at < len(self.text):
            sign = self.text[self.at]
            self.at += 1
            if sign == "\\" and self.at < len(self.text):
                code = self.text[self.at]
                self.at += 1
                digits = re.match("[0-9a-fA-F]{4}", self.text[self.at : self.at + 4]) if code == "u" else None
                out.append(chr(int(digits[0], 16)) if digits else _ESCAPES.get(code, code))
                self.at += 4 if digits else 0
            elif sign == close and self.closes(self.at, ends):
                break
            else:
                out.append(sign)
        return "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")

    def word(self, ends: str):
        start = self.at
        while self.at < len(self.text) and self.text[self.at] not in ends and self.text[self.at] not in "{}[]\n":
            if self.text[self.at].isspace() and "}" in ends and _KEY.match(self.text, self.at):
                break  # a comma is missing
            self.at += 1
        if self.at == start:
            self.at += 1  # a sign that begins nothing
            return ""
        said = self.text[start : self.at].strip().strip("\"'")
        if said.lower() in _WORDS:
            return _WORDS[said.lower()]
        return json.loads(said) if _NUMBER.fullmatch(said) and not re.match(r"-?0\d", said) else said


def repair(text: str | None) -> str | None:
    """The JSON text of the first object or list in ``text``; null if there is none."""
    at = re.search(r"[{\[]", text or "")
    if not at:
        return None
    reader = Tolerant(text)
    reader.at = at.start()
    return json.dumps(reader.value(""), ensure_ascii=False)


def repaired_json(text: Column) -> Column:
    """The JSON of a reply: as ``json_text`` gives it if that can be read, else repaired; null if nothing is there. Only
    broken replies are sent to Python."""

    @F.pandas_udf("string")
    def mend(texts: pd.Series) -> pd.Series:
        return texts.map(repair)

    plain = json_text(text)
    good = F.coalesce(F.try_parse_json(plain).isNotNull() & plain.rlike(r"^\s*[{\[]"), F.lit(False))
    return F.when(good, plain).otherwise(mend(F.when(~good, text)))
