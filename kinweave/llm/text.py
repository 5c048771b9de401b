"""Text conventions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The six characters of ``[\x20\x09-\x0D]``; a word is a longest run of others.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def without_blanks(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def free_name(columns: list[str], stem: str = "own") -> str:
    """A column name that none of ``columns`` has, whatever the case; operators that keep all columns put their own into one struct of it."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c.replace('`', '``')}`") for c in columns]
