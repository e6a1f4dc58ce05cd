"""Word-count family: tokenize, count, filter, format, line metrics, lengths.

All operators are ``DataFrame -> DataFrame`` and work on batch and streaming
frames alike (counts need an output mode that allows aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import DEFAULT_FILTER_PATTERN
from ..functions.text import (extract_words_apostrophe, format_count, full_match, is_blank_java,
                              length_without_spaces, split_words)


def tokenize(df: DataFrame, text_col: str = "value", keep: Sequence[str | Column] = (),
             out: str = "word", keep_apostrophes: bool = False) -> DataFrame:
    """One row per non-empty word of ``text_col`` (flat-map; no shuffle)."""
    words = extract_words_apostrophe(text_col) if keep_apostrophes else split_words(text_col)
    return (df.select(*keep, F.explode(words).alias(out))
              .where(F.col(out) != ""))


def count_words(df: DataFrame, text_col: str = "value", extra_keys: Sequence[str | Column] = (),
                out_count: str = "n", keep_apostrophes: bool = False) -> DataFrame:
    """Word -> count, optionally per extra keys (e.g. a window).

    Plans as partial HashAggregate -> Exchange(word) -> final HashAggregate, so a
    hot word is pre-combined in every map task before the shuffle.
    """
    keys = list(extra_keys)
    named = [k if isinstance(k, Column) else F.col(k) for k in keys]
    words = tokenize(df, text_col, keep=named, keep_apostrophes=keep_apostrophes)
    key_names = [c for c in words.columns if c != "word"]
    return words.groupBy(*key_names, "word").agg(F.count(F.lit(1)).alias(out_count))


def filter_words(counts: DataFrame, pattern: str = DEFAULT_FILTER_PATTERN,
                 word_col: str = "word") -> DataFrame:
    """Keep the rows whose word fully matches ``pattern``."""
    return counts.where(full_match(word_col, pattern))


def filter_metrics(counts: DataFrame, pattern: str = DEFAULT_FILTER_PATTERN,
                   word_col: str = "word") -> DataFrame:
    """Matched / unmatched word counters as one row (the job's counters as a table)."""
    m = full_match(word_col, pattern)
    return counts.agg(F.count(F.when(m, 1)).alias("matched_words"),
                      F.count(F.when(~m, 1)).alias("unmatched_words"))


def format_counts(counts: DataFrame, key: str = "word", count: str = "n",
                  out: str = "value") -> DataFrame:
    """``word: n`` text lines."""
    return counts.select(format_count(key, count).alias(out))


def line_metrics(lines: DataFrame, line_col: str = "value",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Counters and the line-length distribution: lines, empty lines, sum/min/max length."""
    length = F.length(line_col).cast("bigint")
    return lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count(F.when(is_blank_java(line_col), 1)).alias("empty_lines"),
        F.sum(length).alias("sum_len"),
        F.min(length).alias("min_len"),
        F.max(length).alias("max_len"),
    )


def line_lengths(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """(line, length) and length without spaces in one projection."""
    return df.select(*keep, F.col(col),
                     F.length(col).cast("bigint").alias("len"),
                     length_without_spaces(col).cast("bigint").alias("len_nospace"))


def lengths_long(df: DataFrame, col: str = "value") -> DataFrame:
    """Multi-output form: one row per (value, tag, length) for the two length outputs."""
    return df.select(F.col(col), F.expr(
        f"stack(2, 'length', cast(length({col}) as bigint), "
        f"'length_nospace', cast(length(replace({col}, ' ', '')) as bigint)) as (tag, len)"))
