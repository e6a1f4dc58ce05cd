"""Helpers shared by the operators: tables in the shared folder and input columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

# Characters that the contracts strip or split on: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh table in the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of executors without
    recomputing ``df`` and reads only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession) -> None:
    """Ship the package to the Python workers of this application."""
    ship_package(spark)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the fast built-in ``lower``."""
    return (F.when(F.length(c) == F.octet_length(c), F.lower(c))
             .otherwise(F.translate(c, UPPER, UPPER.lower())))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as it takes to be none of ``df``'s columns."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
