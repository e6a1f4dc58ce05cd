"""Event-time windows in batch (and, where noted, in streaming): tumbling sums,
latest point per key, ride-point projection and pane formatting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import SESSION_GAP_MINUTES
from ..functions.time import epoch_minutes, epoch_ms_to_iso, iso_to_epoch_ms
from . import ordered


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assign_event_time(df: DataFrame, ts_expr: Column, out: str = "ts") -> DataFrame:
    """Attach an event time (see ``functions.time.random_event_time`` / ``hashed_event_time``)."""
    return df.withColumn(out, ts_expr)


def tumbling(ts: str = "ts", size: str = "1 minute") -> Column:
    """Tumbling window column (struct start, end)."""
    return F.window(_c(ts), size).alias("window")


def windowed_sum(df: DataFrame, value: str, ts: str = "ts", size: str = "1 minute",
                 keys: Sequence[str] = (), out: str = "total") -> DataFrame:
    """Sum per tumbling window; a window without rows has no row (no default).

    Partial-aggregated; one window key is one group, combined map-side first.
    """
    return df.groupBy(tumbling(ts, size), *keys).agg(F.sum(_c(value)).alias(out),
                                                    F.count(F.lit(1)).alias("n"))


def sum_without_default(df: DataFrame, value: str, out: str = "total") -> DataFrame:
    """Global sum that yields no row for empty input (not a null row)."""
    return (df.agg(F.sum(_c(value)).alias(out), F.count(F.lit(1)).alias("__n"))
              .where(F.col("__n") > 0).drop("__n"))


def pane_row(df: DataFrame, total: str = "total", timing: str = "timing",
             window: str = "window") -> DataFrame:
    """(total, timing, window) -> dollar_turnover, dollar_timing, dollar_window (minutes)."""
    return df.select(F.col(total).alias("dollar_turnover"), F.col(timing).alias("dollar_timing"),
                     epoch_minutes(F.col(window)["start"]).alias("dollar_window"))


def ride_point(df: DataFrame) -> DataFrame:
    """Ride message row -> point: ride_id, ts_ms (from ISO text), float lat/lon, status."""
    return df.select(F.col("ride_id"), iso_to_epoch_ms("timestamp").alias("ts_ms"),
                     F.col("latitude").cast("float").alias("lat"),
                     F.col("longitude").cast("float").alias("lon"),
                     F.col("ride_status").alias("status"))


def point_to_table_row(df: DataFrame) -> DataFrame:
    """Point -> sink row of the ride table: meter and passenger fields are typed nulls."""
    return df.select(F.col("ride_id"), F.col("lat").cast("double").alias("latitude"),
                     F.col("lon").cast("double").alias("longitude"),
                     F.timestamp_millis("ts_ms").alias("timestamp"),
                     F.lit(None).cast("double").alias("meter_reading"),
                     F.lit(None).cast("double").alias("meter_increment"),
                     F.lit(None).cast("bigint").alias("passenger_count"),
                     F.col("status").alias("ride_status"))


def point_to_message(df: DataFrame) -> DataFrame:
    """Point -> message fields with the time printed back as ISO UTC text."""
    return df.select("lat", "lon", "ride_id", epoch_ms_to_iso("ts_ms").alias("timestamp"),
                     F.col("status").alias("ride_status"))


def latest_point(df: DataFrame, key: str, ts: str, tiebreak: str, point: Sequence[str],
                 extra_keys: Sequence[Column | str] = ()) -> DataFrame:
    """Latest point per key (arg-max by ts); on equal ts the smaller tiebreak stays.

    ``min_by`` over (-time, tiebreak) is a mergeable aggregate: partial per map task, then final, so a
    hot key ships one row per map task.
    """
    order = F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"), F.col(tiebreak).alias("tb"))
    pstruct = F.struct(*[F.col(p).alias(p) for p in point])
    return (df.where(F.col(key).isNotNull())
              .groupBy(key, *extra_keys)
              .agg(F.min_by(pstruct, order).alias("latest"), F.count(F.lit(1)).alias("n_points")))


def sessions_latest(df: DataFrame, key: str, ts: str, tiebreak: str, point: Sequence[str],
                    gap_minutes: int = SESSION_GAP_MINUTES, bucket_ms: int | None = None,
                    by_range: bool = False) -> DataFrame:
    """Per key, half-open gap sessions with their latest point (skew-safe)."""
    return ordered.sessionize(df, key, ts, tiebreak, gap_minutes * 60_000, point, bucket_ms, by_range)
