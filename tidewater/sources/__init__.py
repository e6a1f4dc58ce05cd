"""Sources: files, tables, in-memory rows and streams, all as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole-table scan (parquet). Column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_lines(spark: SparkSession, path_or_glob: str) -> DataFrame:
    """One row per text line, column ``value``; globs accepted."""
    return spark.read.text(path_or_glob)


def read_json_lines(spark: SparkSession, path_or_glob: str, schema) -> DataFrame:
    """One parsed row per JSON line with an explicit schema; bad lines -> ``_corrupt``.

    Parsing happens in ``from_json`` (no inference pass over the data).
    """
    from ..operators.rows import parse_json
    return parse_json(read_lines(spark, path_or_glob), "value", schema)


def from_rows(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    """In-memory collection (small fixtures only)."""
    return spark.createDataFrame(list(rows), schema)


def from_strings(spark: SparkSession, values: Iterable[str], column: str = "value") -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def lines_of(df: DataFrame, text_col: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """Split a text column into lines (``\\n``, ``\\r\\n`` or ``\\r``) like a line reader.

    A final line terminator does not make an extra empty line.
    """
    body = F.regexp_replace(F.col(text_col), r"(\r\n|\r|\n)\z", "")
    return df.select(*keep, F.explode(F.split(body, r"\r\n|\r|\n")).alias("value"))
