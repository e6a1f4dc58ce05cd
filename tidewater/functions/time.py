"""Column expressions for event time: ISO parsing, epoch values, labels, day partitions."""

from __future__ import annotations

import time

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DAY_PARTITION_FORMAT, WINDOW_LABEL_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c) -> Column:
    """Event-time column usable by watermarks (``timestamp_ntz`` is read as UTC)."""
    return _col(c).cast("timestamp")


def iso_to_epoch_ms(c) -> Column:
    """ISO-8601 text with offset and up to ns digits -> epoch milliseconds (floor to ms); null if it is none."""
    return F.unix_millis(_col(c).try_cast("timestamp"))


def epoch_ms_to_iso(c) -> Column:
    """Epoch ms -> ISO-8601 UTC text with millisecond precision and a ``Z``."""
    return F.date_format(F.timestamp_millis(_col(c)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_minutes(c) -> Column:
    """Timestamp -> fractional minutes since the epoch (window start label)."""
    return F.unix_millis(_col(c)) / F.lit(1000.0) / F.lit(60.0)


def window_label(window_col="window") -> Column:
    """``HH:mm-HH:mm`` of a window struct (start, end), UTC."""
    w = _col(window_col)
    return F.concat_ws("-", F.date_format(w["start"], WINDOW_LABEL_FORMAT),
                       F.date_format(w["end"], WINDOW_LABEL_FORMAT))


def day_of_window(window_col="window") -> Column:
    """``yyyyMMdd`` of the window's max timestamp (end - 1 ms)."""
    w = _col(window_col)
    return F.date_format(w["end"] - F.expr("INTERVAL 1 MILLISECOND"), DAY_PARTITION_FORMAT)


def day_of_time_field(c) -> Column:
    """``yyyyMMdd`` of an ISO time (text or timestamp), UTC."""
    return F.date_format(_col(c).cast("timestamp"), DAY_PARTITION_FORMAT)


def day_of_number_field(c) -> Column:
    """Integer field taken as the partition value as it is."""
    return _col(c).cast("bigint").cast("string")


def hashed_event_time(min_ms: int, max_ms: int, *cols) -> Column:
    """Deterministic event time in [min_ms, max_ms) drawn from a hash of ``cols``."""
    span = max_ms - min_ms
    return F.timestamp_millis(F.lit(min_ms) + F.pmod(F.xxhash64(*[_col(c) for c in cols]), F.lit(span)))


def digest_event_time(min_ms: int, max_ms: int, *cols) -> Column:
    """Deterministic event time in [min_ms, max_ms) that other engines draw alike.

    The first 52 bits of the MD5 of the columns as text (nulls as nothing, joined by U+001F), modulo the span.
    """
    text = F.concat_ws("\u001f", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])
    drawn = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return F.timestamp_millis(F.lit(min_ms) + drawn % F.lit(max_ms - min_ms))


def random_event_time(min_ms: int | None = None, max_ms: int | None = None,
                      seed: int | None = None) -> Column:
    """Event time drawn uniformly from [min_ms, max_ms) (per row, random).

    Defaults: from now to one hour later.
    """
    if min_ms is None:
        min_ms = int(time.time() * 1000)
    if max_ms is None:
        max_ms = min_ms + 3_600_000
    span = max_ms - min_ms
    return F.timestamp_millis(F.lit(min_ms) + F.floor(F.rand(seed) * F.lit(span)).cast("bigint"))
