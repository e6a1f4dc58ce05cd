"""Co-grouping of n keyed inputs, id resolution through a lookup, singleton side inputs.

Co-group = tag each input, ``unionByName``, one shuffle on the key. The long
(tagged) form is the scalable result: every value stays its own row. The list
form (one row per key, one list per input) is built from it with
``collect_list`` and is meant for keys whose groups are bounded by the data
model; per-key counts are partial-aggregated and safe for any key skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

TAG = "tag"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tagged_union(inputs: Mapping[str, DataFrame], key: str | Mapping[str, str],
                 values: Mapping[str, Sequence[str]] | None = None, out_key: str = "key") -> DataFrame:
    """Long form: (key, tag, <one struct column per input, filled only for its tag>)."""
    keys = key if isinstance(key, Mapping) else {name: key for name in inputs}
    parts = []
    for name, df in inputs.items():
        cols = list((values or {}).get(name) or [c for c in df.columns if c != keys[name]])
        parts.append(df.select(_col(keys[name]).alias(out_key), F.lit(name).alias(TAG),
                               F.struct(*[F.col(c) for c in cols]).alias(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def cogroup(inputs: Mapping[str, DataFrame], key, values=None, out_key: str = "key") -> DataFrame:
    """Tagged long form; groups stay flat rows. No shuffle here: the keyed
    consumer (aggregate, window, join) clusters by key in its own exchange, with
    partial aggregation or AQE splitting where it applies.
    """
    return tagged_union(inputs, key, values, out_key)


def cogroup_lists(inputs: Mapping[str, DataFrame], key, values=None, out_key: str = "key",
                  sort_lists: bool = True) -> DataFrame:
    """One row per key in any input, one list per input (empty, not null, when absent)."""
    long = tagged_union(inputs, key, values, out_key)
    aggs = []
    for name in inputs:
        lst = F.collect_list(F.col(name))
        aggs.append((F.sort_array(lst) if sort_lists else lst).alias(name))
    return long.groupBy(out_key).agg(*aggs)


def cogroup_counts(inputs: Mapping[str, DataFrame], key, out_key: str = "key") -> DataFrame:
    """One row per key in any input with the number of values from each input."""
    long = tagged_union(inputs, key, {n: [] for n in inputs}, out_key)
    return long.groupBy(out_key).agg(
        *[F.count(F.when(F.col(TAG) == name, 1)).alias(f"n_{name}") for name in inputs])


def resolve_ids(result: DataFrame, choice: DataFrame, via: str = "id2", id_col: str = "id",
                order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Give each choice row the ``id`` of a result row with the same ``via`` key.

    Several results per ``via`` value: take the one first by ``order`` (then by
    id) so the pick is deterministic. Returns (resolved choices, choices with no
    result). The lookup has one row per ``via`` value, so only the choice side
    can be skewed; AQE's skew-join splitting handles that side.
    """
    ordering = F.struct(*[F.col(c) for c in order], F.col(id_col))
    lookup = (result.where(F.col(via).isNotNull())
                    .groupBy(via).agg(F.min_by(F.col(id_col), ordering).alias(id_col)))
    resolved = choice.join(lookup, on=via, how="inner")
    unmatched = choice.join(lookup, on=via, how="left_anti")
    return resolved, unmatched


def singleton(side: DataFrame, what: str = "side input") -> DataFrame:
    """Exactly one row or a runtime error (0 or >1 rows). Output is one row."""
    cols = side.columns
    one = side.agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in cols])
    check = F.assert_true(F.col("__n") == 1, f"{what} must have exactly one row")
    return one.select(*[F.when(check.isNull(), F.col(c)).alias(c) for c in cols])


def with_singleton(df: DataFrame, side: DataFrame, what: str = "side input") -> DataFrame:
    """Attach the one row of ``side`` to every row of ``df``.

    The checked one-row side becomes a scalar subquery: evaluated once, its
    value is inlined into the projection (no join, nothing shuffled).
    """
    one = singleton(side, what)
    packed = one.select(F.struct(*[F.col(c) for c in one.columns]).alias("__one")).scalar()
    return df.withColumn("__one", packed).select(*df.columns, "__one.*")


#: Rows of a task that are numbered together.
CELL_BITS = 16


def group_pages(df: DataFrame, key: str, value: str, page_size: int) -> DataFrame:
    """The values of every key in lists of at most ``page_size``: (key, page, values), pages from 0, all but the last full.

    A key may hold any share of the rows: they are numbered within short runs of the input, and the numbers of
    the runs before come from counts per (key, run). Null is a key, null values stay out of no list. Within a page
    the order is that of the input as it was written once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pages")
    df.select(F.col(key).alias("k"), F.struct(F.col(value).alias("v")).alias("x"),
              F.monotonically_increasing_id().alias("place")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("run", F.shiftright("place", CELL_BITS))
    counts = rows.groupBy("k", "run").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("k").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("k").alias("k2"), F.col("run").alias("run2"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    local = rows.withColumn("local", F.row_number().over(Window.partitionBy("k", "run").orderBy("place")) - 1)
    numbered = local.join(before, F.col("k").eqNullSafe(F.col("k2")) & (F.col("run") == F.col("run2")))
    number = F.col("before") + F.col("local")
    pages = numbered.groupBy("k", F.floor(number / page_size).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(number.alias("number"), "x"))).alias("held"))
    return pages.select(F.col("k").alias(key), "page", F.transform("held", lambda h: h["x"]["v"]).alias("values"))
