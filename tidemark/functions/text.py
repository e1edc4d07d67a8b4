"""Scalar text functions: trimming, lengths, hashes, tokens and n-grams.

Patterns carry (?U) so that Java's classes cover Unicode white space and letters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters of Unicode's White_Space, which are those of (?U)\s.
OUTER_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: What counts as a token for the classifier and for topics.
CLASSIFIER_TOKEN = r"(?U)\b\w\w+\b"
TOPIC_TOKEN = r"(?U)\b[a-zA-Z][a-zA-Z]+\b"


def stripped(text: Column) -> Column:
    """Without outer white space; null becomes ''."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(OUTER_SPACE))


def is_blank(text: Column) -> Column:
    return stripped(text) == ""


def word_count(text: Column) -> Column:
    """Words between white space."""
    own = stripped(text)
    return F.when(own == "", F.lit(0)).otherwise(F.size(F.split(own, r"(?U)\s+"))).cast("long")


def text_hash(text: Column) -> Column:
    """SHA-256 hex of the trimmed text in UTF-8."""
    return F.sha2(stripped(text), 256)


def tokens(text: Column, pattern: str = CLASSIFIER_TOKEN) -> Column:
    """Lower-cased tokens in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def without(words: Column, stop: list[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def grams(words: Column, most: int = 2) -> Column:
    """The words and their n-grams up to most words, joined by spaces."""
    def runs(n: int) -> Column:
        spots = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(spots, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.concat(words, *[runs(n) for n in range(2, most + 1)])


def joined_terms(terms: Column, most: int) -> Column:
    return F.array_join(F.slice(terms, 1, most), ", ")
