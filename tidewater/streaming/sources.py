"""Stream sources over files (the production swap is ``format("kafka")``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import message_log


def table_files(sf_dir: str, name: str) -> str:
    """Path pattern for one parquet table (a file or a directory of files).

    The file stream source lists a directory; written as a glob that matches
    exactly ``<name>.parquet`` it also accepts a single-file table.
    """
    return f"{sf_dir.rstrip('/')}/{name}[.]parquet"


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over files appearing under ``path`` (oldest first)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def string_stream(spark: SparkSession, topic: str | None = None, subscription: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Strings from exactly one of a topic or a subscription (here: a directory of
    text files), passed through unchanged as column ``value``.
    """
    if (topic is None) == (subscription is None):
        raise ValueError("exactly one of topic or subscription is required")
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(topic or subscription)


def message_stream(spark: SparkSession, path: str | None = None, max_files_per_trigger: int | None = None,
                   fmt: str = "json", options: dict | None = None, ts: str = "ts", payload: str = "payload") -> DataFrame:
    """Messages as (ts, payload bytes): the event time comes from the message's ``ts``
    attribute, not from the payload.

    By default JSON lines ``{"ts": <event time>, "payload": <text>}`` in files. Any other
    streaming source that has a time and a payload column is named by ``fmt``, ``options`` and
    the two column names (a message bus: its record time and its value).
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "json":
        r = r.schema("ts timestamp, payload string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.load(path) if path else r.load()
    return rows.select(F.col(ts).cast("timestamp").alias("ts"), F.col(payload).cast("binary").alias("payload"))


def log_stream(spark: SparkSession, path: str, positions: str | None = None, max_messages: int = 0,
               split_bytes: int = 64 << 20) -> DataFrame:
    """Messages of append-only files with their offsets: (shard, segment, position, value bytes).

    ``max_messages`` bounds a batch and needs ``positions``, a file of the query's own (see
    :mod:`~tidewater.streaming.message_log`).
    """
    message_log.register(spark)
    r = spark.readStream.format(message_log.NAME).option("splitBytes", split_bytes).option("maxMessages", max_messages)
    return (r.option("positions", positions) if positions else r).load(path)


def log_messages(log: DataFrame) -> DataFrame:
    """Lines ``{"ts": <event time>, "payload": <text>, "attributes": {name: text}}`` of :func:`log_stream` as
    (shard, segment, position, ts, payload bytes, attributes), the attributes apart from the payload.

    A line that is no such object has null ts, payload and attributes; its offset still names it.
    """
    m = F.from_json(F.col("value").cast("string"), "ts timestamp, payload string, attributes map<string,string>")
    return log.withColumn("_m", m).select("shard", "segment", "position", F.col("_m.ts").alias("ts"),
                                          F.col("_m.payload").cast("binary").alias("payload"),
                                          F.col("_m.attributes").alias("attributes"))
