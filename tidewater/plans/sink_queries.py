"""Sink queries: write with the library's sinks into the shared folder, read back, count."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sinks, sources
from ..functions.text import format_count
from ..operators import checks
from ..operators.observe import observed
from ..session import ensure_utc, scratch_path
from .registry import query

EVENTS_TABLE = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])


@query("day_partitions", "SNK3 SNK4 SNK5", sql=r"""
WITH p AS (
  SELECT 'time' AS mode, strftime(ts, '%Y%m%d') AS day, value FROM events
  UNION ALL SELECT 'window', strftime(time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE - INTERVAL 1 MILLISECOND, '%Y%m%d'), value FROM events
  UNION ALL SELECT 'number', (user_id % 7)::VARCHAR, value FROM events)
SELECT mode, day, count(*)::BIGINT AS n, round(sum(value), 2) AS total FROM p GROUP BY 1, 2
""")
def day_partitions(spark, sf_dir):
    """Events in tables partitioned by a time field, by their window's last instant, and by a number."""
    ensure_utc(spark)
    ev = sources.table(spark, sf_dir, "events").withColumn("timestamp", F.col("ts").cast("timestamp"))
    path = scratch_path(spark, "events_by_day")
    sinks.append_day_partitioned(ev, path, EVENTS_TABLE, "timestamp", "day")
    parts = [sinks.read_table(spark, path).select(F.lit("time").alias("mode"), "day", "value")]
    windows = ev.withColumn("window", F.window("timestamp", "10 minutes"))
    for mode, rows in (("window", sinks.day_partition(windows, "window", out="day")),
                       ("number", sinks.day_partition(ev.withColumn("n7", F.col("user_id") % 7), "number", "n7", "day"))):
        path = scratch_path(spark, f"events_by_{mode}")
        rows.select("value", "day").hint("rebalance", "day").write.partitionBy("day").parquet(path)
        parts.append(spark.read.parquet(path).select(F.lit(mode).alias("mode"), F.col("day").cast("string"), "value"))
    every = parts[0].union(parts[1]).union(parts[2])
    return every.groupBy("mode", "day").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("window_files", "SNK2 SNK1 PRJ3", sql=r"""
WITH c AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, event_type, count(*) AS n
  FROM events GROUP BY 1, 2
)
SELECT strftime(ws, '%Y%m%d') AS day,
       strftime(ws, '%H:%M') || '-' || strftime(ws + INTERVAL 1 HOUR, '%H:%M') AS window_label,
       count(*)::BIGINT AS n_lines, sum(n)::BIGINT AS n_events, true AS named
FROM c GROUP BY 1, 2
""")
def window_files(spark, sf_dir):
    ensure_utc(spark)
    ev = sources.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = ev.groupBy(F.window("ts", "1 hour").alias("window"), "event_type") \
               .agg(F.count(F.lit(1)).alias("n"))
    lines = counts.select("window", format_count("event_type", "n").alias("value"))
    path = scratch_path(spark, "window_files")
    sinks.write_per_window(lines, path, "window", "value")
    back = sinks.read_window_files(spark, path)
    n = F.element_at(F.split("value", ": "), -1).cast("bigint")
    # Every window has the files 0 to N - 1 of the N that their names tell.
    named = (F.count_distinct("shard") == F.max("shards")) & (F.min("shards") == F.max("shards")) & (F.max("shard") == F.max("shards") - 1)
    return back.groupBy(F.col("day").cast("string").alias("day"), "window_label").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(n).alias("n_events"), named.alias("named"))


@query("table_scan", "SRC4 SNK7", sql=r"""
SELECT l_returnflag, count(*)::BIGINT AS n, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_price
FROM lineitem GROUP BY l_returnflag
""")
def table_scan(spark, sf_dir):
    li = observed(sources.table(spark, sf_dir, "lineitem"), "lineitem_scan")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                         F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
                                         F.round(F.sum("l_extendedprice"), 2).alias("sum_price"))


@query("copy_check", "UDF5", sql=r"""
SELECT 'copy' AS name, true AS same, count(*)::BIGINT AS n FROM events
UNION ALL SELECT 'changed', count(*) FILTER (event_id % 1000 = 0) = 0, count(*) FROM events
UNION ALL SELECT 'nulled', count(*) FILTER (event_id % 1000 = 1) = 0, count(*) FROM events
UNION ALL SELECT 'repeated', count(*) FILTER (event_id % 1000 = 2) = 0, (count(*) + count(*) FILTER (event_id % 1000 = 2)) FROM events
""")
def copy_check(spark, sf_dir):
    """The events against copies of them, read back in another order: an exact one, and three with a few rows changed."""
    ev = sources.table(spark, sf_dir, "events")
    path = scratch_path(spark, "events_copy")
    ev.repartition(7, "user_id").write.parquet(path)
    copy, i = spark.read.parquet(path), F.col("event_id")
    copies = {"copy": copy, "changed": copy.withColumn("value", F.when(i % 1000 == 0, F.col("value") + 1).otherwise(F.col("value"))),
              "nulled": copy.withColumn("value", F.when(i % 1000 != 1, F.col("value"))),
              "repeated": copy.union(copy.where(i % 1000 == 2))}
    want = checks.fingerprint(ev).select(F.struct("n", "h1", "h2").alias("want"))
    rows = None
    for name, df in copies.items():
        got = checks.fingerprint(df).select(F.lit(name).alias("name"), F.struct("n", "h1", "h2").alias("got"))
        rows = got if rows is None else rows.union(got)
    return rows.select("name", (F.col("got") == want.scalar()).alias("same"), F.col("got.n").alias("n"))
