"""Column expressions on text that several operators share. All are native Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import let as let

#: White space between words, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RE = "[\\x20\\x09-\\x0D]+"
WORD_RE = "[^\\x20\\x09-\\x0D]"
WORD_START_RE = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Array of words; empty for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RE, -1), "")


def lines(text: Column) -> Column:
    """Array of \\n-split lines; one empty line for null or empty text."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def has_word(line: Column) -> Column:
    return line.rlike(WORD_RE)


def count(text: Column, chars: str) -> Column:
    """How many characters of text are among chars."""
    return F.regexp_count(text, F.lit("[" + "".join("\\" + c if c in "\\]^-[&" else c for c in chars) + "]"))


def solid(text: Column) -> Column:
    """Characters other than blanks."""
    return F.length(text) - F.regexp_count(text, F.lit("[\\x20\\x09-\\x0D]"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever it has: for columns that an operator makes for itself."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
