"""Trigram sets: words are lower-cased and padded with two spaces in front and one behind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.functions.text import col


def trigrams(c) -> Column:
    """Distinct trigrams of all words of a text."""
    words = F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{Nd}]+"), lambda w: w != "")
    grams = F.transform(
        words,
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.substr(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(grams))


def similarity(a, b) -> Column:
    """Shared trigrams over all trigrams, 0 when both are empty."""
    common = F.size(F.array_intersect(col(a), col(b)))
    total = F.size(col(a)) + F.size(col(b)) - common
    return F.when(total > 0, common / total).otherwise(F.lit(0.0))
