"""The two ride jobs over one message stream, and helpers to run a query to the end.

Turnover (STR10): message -> row -> meter_increment -> 1-minute sums with
EARLY/ON_TIME/LATE panes (5 minutes lateness) -> {dollar_turnover,
dollar_timing, dollar_window} JSON -> stream.

Positions (STR11): message -> point keyed by ride -> 60-minute sessions with
early rows -> latest point per session -> JSON stream, and (rows with a status)
the day-partitioned ride table. Both position outputs come from one query
through ``foreachBatch`` (the batch is cached, written twice and committed once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import sinks
from ..functions.constants import (POSITIONS_EARLY_SECONDS, RIDE_MESSAGE_FIELDS, RIDE_TABLE_DDL, SESSION_GAP_MINUTES,
                                   TURNOVER_EARLY_SECONDS, TURNOVER_LATENESS_MINUTES, WORD_WINDOW_MINUTES)
from ..functions.text import format_count
from ..functions.time import iso_to_epoch_ms
from ..operators import rows as R
from ..operators.words import count_words
from .state import RETRACTED, pane_sums, session_updates


def parsed_rides(messages: DataFrame) -> DataFrame:
    """(ts, payload) -> ts, the ride fields as text, and ``_corrupt`` (the payload if it is no JSON object).

    Numbers stay text here: each branch converts what it needs, so that a
    bad meter does not lose a position. Rejects: :func:`ride_rejects`.
    """
    ddl = ", ".join(f"{f} string" for f in RIDE_MESSAGE_FIELDS)
    parsed = R.parse_message(messages, "payload", ddl, keep=["ts"])
    return parsed.select("ts", "row.*", R.CORRUPT)


def meter_value(c: str = "meter_increment"):
    return R.extract_double(c)


def ride_rejects(rides: DataFrame) -> DataFrame:
    """One row per branch that cannot use a message: (ts, branch, reason, message).

    ``undecodable`` payloads are lost to both branches; turnover needs a numeric
    ``meter_increment`` (``no_meter``, ``bad_meter``), positions a ``ride_id`` and a time (``no_ride_id``,
    ``bad_time``).
    """
    corrupt = F.col(R.CORRUPT).isNotNull()
    turnover_reason = (F.when(corrupt, "undecodable").when(F.col("meter_increment").isNull(), "no_meter")
                        .when(meter_value().isNull(), "bad_meter"))
    position_reason = (F.when(corrupt, "undecodable").when(F.col("ride_id").isNull(), "no_ride_id")
                        .when(iso_to_epoch_ms("timestamp").isNull(), "bad_time"))
    message = F.coalesce(F.col(R.CORRUPT), F.to_json(F.struct(*RIDE_MESSAGE_FIELDS)))
    both = F.array(F.struct(F.lit("turnover").alias("branch"), turnover_reason.alias("reason")),
                   F.struct(F.lit("positions").alias("branch"), position_reason.alias("reason")))
    return (rides.select("ts", F.explode(both).alias("r"), message.alias("message"))
                 .select("ts", "r.branch", "r.reason", "message").where(F.col("reason").isNotNull()))


def turnover(rides: DataFrame, lateness_minutes: int = TURNOVER_LATENESS_MINUTES,
             output_mode: str = "append", early_seconds: float = 0) -> DataFrame:
    """Pane rows: dollar_turnover, dollar_timing, dollar_window (start, fractional minutes)."""
    amounts = rides.where(F.col(R.CORRUPT).isNull()).select("ts", meter_value().alias("value")) \
                   .where(F.col("value").isNotNull())
    panes = pane_sums(amounts, "ts", "value", 1, lateness_minutes, output_mode=output_mode,
                      early_seconds=early_seconds)
    return panes.select("dollar_turnover", "dollar_timing",
                        (F.col("window_start_ms") / F.lit(1000.0) / F.lit(60.0)).alias("dollar_window"))


def positions(rides: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES, out_of_order_minutes: int = 0,
              early_seconds: float = 0) -> DataFrame:
    """Latest point per ride session, one row per change (EARLY) and per close (ON_TIME).

    Sessions form by the message time ``ts``; the latest point is the one of
    the largest payload time, the first seen of equal ones.
    """
    pts = rides.where(F.col(R.CORRUPT).isNull() & F.col("ride_id").isNotNull()).select(
        "ride_id", "ts", iso_to_epoch_ms("timestamp").alias("ts_ms"),
        F.col("latitude").try_cast("float").alias("lat"), F.col("longitude").try_cast("float").alias("lon"),
        F.col("ride_status").alias("status"))
    return session_updates(pts, "ride_id", "ts", None, ["lat", "lon", "ts_ms", "status"],
                           ["float", "float", "long", "string"], gap_minutes, "ts_ms", out_of_order_minutes,
                           early_seconds)


POSITION_LOG_DDL = "value string, ride_id string, session_start_ms bigint, timing string, batch_id bigint"


def position_log(updates: DataFrame) -> DataFrame:
    """Session updates -> JSON text of the point, the session it belongs to, and the day of the point."""
    point = F.struct("lat", "lon", "ride_id",
                     F.date_format(F.timestamp_millis("ts_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
                     F.col("status").alias("ride_status"))
    text = F.when(F.col("timing") != RETRACTED, F.to_json(point, {"ignoreNullFields": "false"}))
    return updates.select(text.alias("value"), "ride_id", "session_start_ms", "timing",
                          F.date_format(F.timestamp_millis("ts_ms"), "yyyyMMdd").alias("day"))


def ride_table_rows(updates: DataFrame) -> DataFrame:
    """Session updates -> rows of the ride table (meter and passenger fields null)."""
    return updates.where(F.col("status").isNotNull()).select(
        "ride_id", F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        F.timestamp_millis("ts_ms").alias("timestamp"),
        F.lit(None).cast("double").alias("meter_reading"),
        F.lit(None).cast("double").alias("meter_increment"),
        F.lit(None).cast("bigint").alias("passenger_count"),
        F.col("status").alias("ride_status"))


def start_turnover(messages: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None,
                   early_seconds: float = TURNOVER_EARLY_SECONDS) -> StreamingQuery:
    """Every pane firing as a JSON line in the files under ``out_path`` (the file sink's log makes it exactly once)."""
    rows = sinks.json_lines(turnover(parsed_rides(messages), early_seconds=early_seconds))
    w = rows.writeStream.format("text").outputMode("append").option("path", out_path) \
            .option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def start_rejects(messages: DataFrame, out_path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """The messages that a branch cannot use, with the reason, as JSON files; counts per batch in the progress."""
    rejects = ride_rejects(parsed_rides(messages)).observe("ride_rejects", F.count(F.lit(1)).alias("rejects"))
    w = rejects.writeStream.format("json").outputMode("append").option("path", out_path) \
               .option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def start_positions(messages: DataFrame, json_path: str, table_path: str, checkpoint: str,
                    trigger: dict | None = None, out_of_order_minutes: int = 0,
                    early_seconds: float = POSITIONS_EARLY_SECONDS) -> StreamingQuery:
    """Session updates as JSON rows and, for rows with a status, in the day-partitioned ride table.

    The JSON rows are a log of upserts by (ride_id, session_start_ms); a RETRACTED row has no
    value and takes the session of that start back.

    The tables are created with their declared schema if they are missing, and checked, once at
    the start. A batch's rows of both become visible at once, by one commit (:func:`sinks.commit_batch`); a batch that
    is run again after a failure leaves no row twice and none out. Read them by :func:`sinks.read_table`.
    """
    updates = positions(parsed_rides(messages), out_of_order_minutes=out_of_order_minutes, early_seconds=early_seconds)
    spark = messages.sparkSession
    log = f"{json_path.rstrip('/')}/{sinks.COMMITS}"
    table_schema = T.StructType([*T._parse_datatype_string(RIDE_TABLE_DDL).fields, T.StructField("batch_id", T.LongType())])
    sinks.ensure_table(spark, table_path, table_schema, ("day",), log)
    sinks.ensure_table(spark, json_path, T._parse_datatype_string(POSITION_LOG_DDL), ("day",), log)

    def write_both(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            table = ride_table_rows(batch.where(F.col("timing") != RETRACTED)).withColumn("day", F.date_format("timestamp", "yyyyMMdd"))
            number = F.lit(batch_id).cast("bigint")
            sinks.commit_batch(spark, log, checkpoint, batch_id, {
                json_path: position_log(batch).withColumn("batch_id", number),
                table_path: table.withColumn("batch_id", number)})
        finally:
            batch.unpersist()

    w = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint) \
               .foreachBatch(write_both)
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def start_windowed_word_count(lines: DataFrame, out_path: str, checkpoint: str,
                              window_minutes: int = WORD_WINDOW_MINUTES, lateness_minutes: int = 0,
                              num_shards: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Windowed word count on a stream of (ts, value) lines, written as one set of
    ``word: n`` files per window (per micro-batch directory).

    Append mode: a window is written once, when the watermark passes its end.
    """
    counts = count_words(lines.withWatermark("ts", f"{lateness_minutes} minutes"), "value",
                         extra_keys=[F.window("ts", f"{window_minutes} minutes").alias("window")])
    rows = counts.select("window", format_count("word", "n").alias("value"))

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_per_window(batch, f"{out_path.rstrip('/')}/batch_id={batch_id}", "window", "value",
                               num_shards)

    w = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def start_string_passthrough(spark: SparkSession, topic: str | None = None,
                             subscription: str | None = None, trigger: dict | None = None,
                             checkpoint: str | None = None) -> StreamingQuery:
    """Strings from exactly one of a topic or a subscription, passed through
    unchanged; instead of logging every element, per-batch counters
    (``strings``, ``chars``) are observed and reported in the query progress.
    """
    from .sources import string_stream
    lines = string_stream(spark, topic=topic, subscription=subscription)
    seen = lines.observe("strings_seen", F.count(F.lit(1)).alias("strings"),
                         F.sum(F.length("value")).alias("chars"))
    w = seen.writeStream.format("noop").outputMode("append")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def start_batches(df: DataFrame, out_path: str, checkpoint: str, mode: str = "update", fmt: str = "parquet",
                  json_payload: bool = False, trigger: dict | None = None) -> StreamingQuery:
    """A query that writes each micro-batch under ``out_path/batch_id=<id>``."""
    w = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
           .foreachBatch(sinks.batch_writer(out_path, fmt, json_payload)))
    return w.trigger(**(trigger or AT_ONCE)).start()


def run_available(df: DataFrame, out_path: str, checkpoint: str, mode: str = "update",
                  fmt: str = "parquet", json_payload: bool = False) -> None:
    """Run a streaming DataFrame over everything available now, batch by batch,
    writing each micro-batch under ``out_path/batch_id=<id>``; wait for the end.
    """
    finish(start_batches(df, out_path, checkpoint, mode, fmt, json_payload, {"availableNow": True}))


def finish(q: StreamingQuery) -> None:
    """Wait for a query's end and raise what ended it."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


AT_ONCE = {"processingTime": "0 seconds"}


def replay(rows: DataFrame, step: Column, steps: int, feed: str, write, start) -> None:
    """Feed ``rows`` to one running stream in ``steps`` micro-batches.

    ``step`` numbers the batches (0 to steps - 1) and may be any expression of the row. The rows of a step are
    written aside and then moved under ``feed`` as one folder, so the stream sees all of its files at once;
    the next step follows when they are done. ``start()`` starts the query over ``step_files(feed)``.
    """
    numbered, query = rows.withColumn("__step", step), None
    try:
        for k in range(steps):
            write(numbered.where(F.col("__step") == k).drop("__step"), f"{feed}/_next")
            sinks.move(rows.sparkSession, f"{feed}/_next", f"{feed}/step-{k}")
            query = query or start()
            query.processAllAvailable()
    finally:
        if query is not None:
            query.stop()


def step_files(feed: str) -> str:
    return f"{feed}/step-*"


def latest_by_batch(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """Upsert view of a batch-per-directory output: per key, the row of the last batch."""
    return latest_rows(spark.read.parquet(out_path), keys)


def latest_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the row of the last batch (column ``batch_id``)."""
    payload = [c for c in rows.columns if c not in keys and c != "batch_id"]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col("batch_id")).alias("__r"))
    return latest.select(*keys, "__r.*")
