"""Column expressions for text: tokenizing, full-match filters, Java-style blank test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import APOSTROPHE_WORD_PATTERN, COUNT_SEPARATOR, TOKENIZER_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text) -> Column:
    """Array of words of ``text`` (letters only); may hold empty strings at the edges."""
    return F.split(_col(text), TOKENIZER_PATTERN)


def extract_words_apostrophe(text) -> Column:
    """Array of letter/apostrophe runs (variant tokenizer)."""
    return F.regexp_extract_all(_col(text), F.lit(APOSTROPHE_WORD_PATTERN), 0)


def full_match(c, pattern: str) -> Column:
    """True when the whole value matches ``pattern`` (Java ``Matcher.matches``)."""
    return _col(c).rlike(r"\A(?:" + pattern + r")\z")


def is_blank_java(c) -> Column:
    """Java ``trim().isEmpty()``: every char is <= U+0020 (Spark ``trim`` keeps tabs)."""
    return _col(c).rlike(r"\A[\x00-\x20]*\z")


def format_count(key, count) -> Column:
    """``key + ": " + count``."""
    return F.concat_ws(COUNT_SEPARATOR, _col(key), _col(count).cast("string"))


def length_without_spaces(c) -> Column:
    return F.length(F.replace(_col(c), F.lit(" "), F.lit("")))
