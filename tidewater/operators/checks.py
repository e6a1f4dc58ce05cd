"""Content checks inside a running job (``containsInAnyOrder`` style), by fingerprints that do not depend on order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContentMismatch(AssertionError):
    pass


def _row_hash(cols: list[str], seed: int) -> Column:
    """64 bits of a row. Nulls are told apart by place, as the built-in hash passes over them."""
    parts = [x for c in cols for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row of a multiset of rows: their number and two exact sums of independent 64-bit hashes.

    Equal multisets have equal fingerprints whatever the order and the partitions. One pass that sums in the
    tasks; sums of parts (or micro-batches) add up to that of the whole.
    """
    cols = cols or df.columns
    none = F.lit(0).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(_row_hash(cols, s)).cast("decimal(38,0)"), none).alias(f"h{s}")
                                                  for s in (1, 2)])


def same_rows(df: DataFrame, expected: DataFrame) -> bool:
    """Whether two tables hold the same rows as multisets; types are those of ``expected``."""
    cols = expected.columns
    typed = df.select(*[F.col(f"`{c}`").cast(expected.schema[c].dataType).alias(c) for c in cols])
    return len(fingerprint(typed).union(fingerprint(expected)).distinct().take(2)) == 1


def expect_rows(df: DataFrame, expected: DataFrame) -> None:
    """Raise unless ``df`` holds exactly the rows of ``expected`` (as multisets).

    Fingerprints decide; only if they differ two ``exceptAll`` anti-joins find the rows, and their (small)
    sizes and some examples reach the driver.
    """
    if same_rows(df, expected):
        return
    cols = expected.columns
    missing = expected.exceptAll(df.select(*cols))
    extra = df.select(*cols).exceptAll(expected)
    raise ContentMismatch(f"{missing.count()} expected rows missing, {extra.count()} unexpected rows; "
                          f"e.g. missing {missing.take(3)}, extra {extra.take(3)}")
