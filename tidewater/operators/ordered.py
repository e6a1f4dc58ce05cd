"""Order-dependent operators per key, exact and safe under key skew.

A window ``partitionBy(key)`` sends every row of a key to one task; with a key
holding a third of the data that task is the whole job. Here each key is cut
into *cells*, slices of event time, and the window runs per ``(key, cell)``: one
shuffle of the data, and groups that hold one key's rows of one slice. The
slice's width is the knob: a key with r events a second has r * width rows in a cell.

What crosses a cell edge comes from a small per-``(key, cell)`` aggregate
(partial-aggregated, so a hot key costs one row per cell and map task) and is
injected as a *sentinel* row into the neighbouring cell's partition, where the
ordinary ``lead``/``lag`` sees it. Two scans of the data, whatever its size and
skew: the aggregate and the rows. No join of the data with itself, no Python.

The windows over the cells of a key see one row per cell (for sessions, per local
session): at most the key's time span divided by the slice (or the gap).

With ``by_range`` the cells are range partitions of (key, ts, tiebreak) instead (:func:`range_cells`): no slice width, and
a burst of one key at one instant is split as well. A cell then holds about rows / partitions whatever the keys and
times are, and at most partitions - 1 (key, cell) pairs have a successor. It costs a shuffle, Spark's sampling pass and
a written table more, and a job when it is called.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Width of a cell. Lead is used on keys of few values (event names, types), which are
# hot by nature; sessions on many keys (rides, users), where a wider cell keeps
# the aggregate small against the data.
DEFAULT_BUCKET_MS = 10_000
SESSION_BUCKET_MS = 300_000
_SENT = "__sentinel"
_BKT = "__bucket"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_bucket(ts, bucket_ms: int = DEFAULT_BUCKET_MS) -> Column:
    """Cell number of a timestamp column (``timestamp_ntz`` is read as UTC)."""
    return F.floor(F.unix_millis(_c(ts).cast("timestamp")) / F.lit(bucket_ms)).cast("bigint")


def range_cells(df: DataFrame, *order, partitions: int | None = None) -> DataFrame:
    """``df`` with the number of its range partition by ``order`` as its cell, written once to the shared folder.

    The bounds come from Spark's sample of the data, which another run of the same plan may draw differently: the
    table fixes them for all that read the cells. Equal rows in ``order`` stay in one cell, so end it by a unique column.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "range_cells")
    placed = df.repartitionByRange(n, *order).withColumn(_BKT, F.spark_partition_id().cast("bigint"))
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def lead_within(df: DataFrame, key: str, ts: str, tiebreak: str, value: str | None, out: str,
                bucket_ms: int = DEFAULT_BUCKET_MS, of_time: Callable[[Column], Column] | None = None,
                by_range: bool = False, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the next row of the same ``key`` by (ts, tiebreak).

    The last row of a key gets null. Rows with a null ``ts`` are not ordered and
    get null too. Where the value is a function of ``ts``, give ``of_time`` instead of ``value``:
    a cell's first value then needs no more than its smallest time (a hash aggregate).
    ``by_range`` takes range partitions (``partitions`` of them) as cells instead of slices of time.
    """
    cut = range_cells(df, key, ts, tiebreak, partitions=partitions) if by_range else df.withColumn(_BKT, time_bucket(ts, bucket_ms))
    base = cut.withColumn(_SENT, F.lit(False))
    timed = base.where(F.col(ts).isNotNull()).groupBy(key, _BKT)
    cells = Window.partitionBy(key).orderBy(_BKT)
    if of_time is None:
        heads = timed.agg(F.min_by(F.struct(F.col(value).alias("v")), F.struct(F.col(ts), F.col(tiebreak))).alias("__head"))
        carried, read = value, "__next.v"
    else:
        heads = timed.agg(F.min(ts).alias("__head"))
        carried, read = ts, "__next"
    nxt = heads.withColumn("__next", F.lead("__head").over(cells)).where(F.col("__next").isNotNull())
    sentinels = nxt.select(F.col(key), F.col(_BKT), F.lit(True).alias(_SENT), F.col(read).alias(carried))
    allrows = base.unionByName(sentinels, allowMissingColumns=True)
    w = Window.partitionBy(key, _BKT).orderBy(F.col(_SENT), F.col(ts), F.col(tiebreak))
    following = F.lead(_c(carried)).over(w)
    led = allrows.withColumn(out, F.when(F.col(ts).isNotNull(), of_time(following) if of_time else following))
    return led.where(~F.col(_SENT)).drop(_SENT, _BKT)


def sessionize(df: DataFrame, key: str, ts: str, tiebreak: str, gap_ms: int,
               point: Sequence[str], bucket_ms: int | None = None, by_range: bool = False,
               partitions: int | None = None) -> DataFrame:
    """Half-open gap sessions per key, one row per session.

    A new session starts when ``ts - previous ts >= gap`` (two events exactly one
    gap apart are two sessions). Output: key, ``session_start``, ``last_ts``,
    ``session_end`` (= last_ts + gap), ``n_events`` and ``latest`` = struct of
    ``point`` columns of the last event by (ts, tiebreak); on equal ts the
    earlier tiebreak wins, so equal-time points keep the first one.
    ``by_range`` takes range partitions (``partitions`` of them) as cells instead of slices of time.
    """
    gap_us = gap_ms * 1000
    rows = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key), F.col(ts), F.col(tiebreak), *[F.col(p) for p in point if p not in (key, ts, tiebreak)])
    # Ranges run the way the cells are ordered below, so that a session's last cell holds its latest point.
    cut = (range_cells(rows, F.col(key), F.col(ts), F.col(tiebreak).desc(), partitions=partitions) if by_range
           else rows.withColumn(_BKT, time_bucket(ts, bucket_ms or SESSION_BUCKET_MS)))
    base = cut.withColumn(_SENT, F.lit(False))
    # Sentinels: the last ts of the previous non-empty cell of the key.
    cells = Window.partitionBy(key).orderBy(_BKT)
    prev = (base.groupBy(key, _BKT).agg(F.max(ts).alias("__tail"))
                .withColumn("__prev", F.lag("__tail").over(cells)).where(F.col("__prev").isNotNull()))
    sentinels = prev.select(F.col(key), F.col(_BKT), F.lit(True).alias(_SENT), F.col("__prev").alias(ts))
    allrows = base.unionByName(sentinels, allowMissingColumns=True)
    # A sentinel sorts first in its cell. Of rows at one time the smallest tiebreak comes last, so
    # that the last row of a session is its latest point.
    spec = Window.partitionBy(key, _BKT).orderBy(F.col(_SENT).desc(), F.col(ts), F.col(tiebreak).desc())
    so_far = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    before = F.lag(ts).over(spec)
    fresh = before.isNull() | (us - F.unix_micros(before.cast("timestamp")) >= F.lit(gap_us))
    flagged = allrows.withColumn("__new", ~F.col(_SENT) & fresh).withColumn("__at", F.row_number().over(spec))
    begun = (flagged.withColumn("__lsid", F.count(F.when(F.col("__new"), 1)).over(so_far))
                    .withColumn("__from", F.max(F.when(F.col("__new") | F.col(_SENT), F.col("__at"))).over(so_far))
                    .withColumn("__first", F.last(F.when(F.col("__new"), F.col(ts)), ignorenulls=True).over(so_far))
                    .withColumn("__cell_first", F.first(F.when(~F.col(_SENT), F.col(ts)), ignorenulls=True).over(so_far))
                    .withColumn("__ends", F.coalesce(F.lead("__new").over(spec), F.lit(True))))
    # One row per local session, its last one; number 0 continues the previous cell's session.
    continues = F.col("__lsid") == 0
    parts = begun.where(F.col("__ends") & ~F.col(_SENT)).select(
        key, _BKT, "__lsid", F.coalesce("__first", "__cell_first").alias("session_start"), F.col(ts).alias("last_ts"),
        (F.col("__at") - F.col("__from") + F.when(continues, 0).otherwise(1)).cast("bigint").alias("n_events"),
        F.struct(*[F.col(p).alias(p) for p in point]).alias("latest"))
    # A local session's root is itself unless it continues: then the last fresh one before it.
    root = F.when(F.col("__lsid") >= 1, F.struct(F.col(_BKT).alias("b"), F.col("__lsid").alias("l")))
    kw = Window.partitionBy(key).orderBy(_BKT, "__lsid")
    rooted = parts.withColumn("__root", F.last(root, ignorenulls=True).over(
        kw.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # The parts of a session follow one another: running values at its last part are the session's.
    nxt = F.lead("__root").over(kw)
    session = Window.partitionBy(key, "__root").orderBy(_BKT, "__lsid")
    merged = (rooted.withColumn("__last", nxt.isNull() | (nxt != F.col("__root")))
                    .withColumn("session_start", F.min("session_start").over(session))
                    .withColumn("n_events", F.sum("n_events").over(session)).where("__last"))
    return merged.select(key, "session_start", "last_ts",
                         F.timestamp_micros(F.unix_micros(F.col("last_ts").cast("timestamp")) + F.lit(gap_us))
                          .alias("session_end"),
                         "n_events", "latest")
