"""Event-time queries over ``events``: tumbling sums, sessions, latest points, lead."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources
from ..operators import ordered
from ..operators import rows as R
from ..operators import windows as Wn
from ..functions.time import epoch_minutes
from ..session import ensure_utc
from ..operators.cogroup import group_pages
from ..operators.combine import Largest, combine_by_key
from .registry import query


def _events(spark, sf_dir):
    ensure_utc(spark)
    ev = sources.table(spark, sf_dir, "events")
    return ev.withColumn("ts", F.col("ts").cast("timestamp"))


@query("tumbling_sum", "STR1 AGG3 PRJ11 PRJ12", sql=r"""
SELECT epoch_ms(date_trunc('minute', ts)) / 1000.0 / 60.0 AS dollar_window,
       round(sum(value), 2) AS dollar_turnover, count(*)::BIGINT AS n
FROM events GROUP BY date_trunc('minute', ts)
""")
def tumbling_sum(spark, sf_dir):
    ev = _events(spark, sf_dir).select("ts", R.extract_double("value").alias("amount"))
    agg = Wn.windowed_sum(ev, "amount", "ts", "1 minute")
    return agg.select(epoch_minutes(F.col("window.start")).alias("dollar_window"),
                      F.round("total", 2).alias("dollar_turnover"), "n")


@query("latest_point_batch", "AGG4 PRJ9 PRJ10 FLT2 UDF3", sql=r"""
SELECT user_id, (epoch_us(ts) // 1000) AS ts_ms, event_id, event_type, value, n_points
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id ASC) AS rn,
             count(*) OVER (PARTITION BY user_id) AS n_points
      FROM events)
WHERE rn = 1 AND event_type IS NOT NULL
""")
def latest_point_batch(spark, sf_dir):
    # Key rows by user (rows without a key would go to R.null_keys), take the
    # latest point per key, drop the key wrapper, keep points that carry a type.
    keyed = R.with_key(R.key_by(_events(spark, sf_dir), "user_id"))
    lp = Wn.latest_point(keyed, "key", "ts", "event_id", ["user_id", "ts", "event_id", "event_type", "value"])
    flat = R.drop_key(lp.select("key", "latest.*", F.col("n_points").cast("bigint")))
    points = R.keep_with_field(flat, "event_type")
    return points.select("user_id", F.unix_millis("ts").alias("ts_ms"), "event_id", "event_type",
                         "value", "n_points")


_SESSIONS_SQL = r"""
WITH e AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events
), f AS (
  SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts >= INTERVAL 60 MINUTE THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM e
), g AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, sid ORDER BY ts DESC, event_id ASC) AS rn,
         count(*) OVER (PARTITION BY user_id, sid) AS n_events,
         min(ts) OVER (PARTITION BY user_id, sid) AS s_start
  FROM f
)
SELECT user_id, (epoch_us(s_start) // 1000) AS session_start_ms, (epoch_us(ts) // 1000) AS last_ms,
       (epoch_us(ts) // 1000) + 3600000 AS session_end_ms, n_events::BIGINT AS n_events,
       event_id AS latest_event_id, value AS latest_value
FROM g WHERE rn = 1
"""


def _sessions(ev, by_range):
    s = Wn.sessions_latest(ev, "user_id", "ts", "event_id", ["event_id", "value"], by_range=by_range)
    return s.select("user_id", F.unix_millis("session_start").alias("session_start_ms"),
                    F.unix_millis("last_ts").alias("last_ms"),
                    F.unix_millis("session_end").alias("session_end_ms"),
                    F.col("n_events").cast("bigint"),
                    F.col("latest.event_id").alias("latest_event_id"),
                    F.col("latest.value").alias("latest_value"))


@query("session_latest", "STR3 AGG4", sql=_SESSIONS_SQL)
def session_latest(spark, sf_dir):
    return _sessions(_events(spark, sf_dir), by_range=False)


@query("session_bursts", "STR3 AGG4 SRT1", sql=_SESSIONS_SQL.replace("FROM events", """FROM (
  SELECT event_type AS user_id, date_trunc('day', ts) AS ts, event_id, value FROM events)"""))
def session_bursts(spark, sf_dir):
    """Sessions of few keys whose events come in bursts at one instant, over range partitions."""
    ev = _events(spark, sf_dir).select(F.col("event_type").alias("user_id"), F.date_trunc("day", "ts").alias("ts"), "event_id", "value")
    return _sessions(ev, by_range=True)


@query("lead_end", "WIN1 SRT1", sql=r"""
SELECT event_id, event_type, (epoch_us(ts) // 1000) AS ts_ms,
       (lead(epoch_us(ts) // 1000) OVER (PARTITION BY event_type ORDER BY ts, event_id))::DOUBLE AS ts_end_ms
FROM events
""")
def lead_end(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "event_type", "ts",
                                       F.unix_millis("ts").alias("ts_ms"))
    # The last event of a type has no end (null): nullable columns are returned
    # as double (exact for epoch ms) so every engine hands over the same type.
    return ordered.lead_within(ev, "event_type", "ts", "event_id", None, "ts_end_ms", of_time=F.unix_millis) \
                  .select("event_id", "event_type", "ts_ms", F.col("ts_end_ms").cast("double").alias("ts_end_ms"))


@query("lead_bursts", "WIN1 SRT1", sql=r"""
SELECT event_id, event_type, (lead(event_id) OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts), event_id))::DOUBLE AS next_id
FROM events
""")
def lead_bursts(spark, sf_dir):
    """The next event of a type where all of a day's events are at one instant, over range partitions."""
    ev = _events(spark, sf_dir).select("event_id", "event_type", F.date_trunc("day", "ts").alias("ts"))
    led = ordered.lead_within(ev, "event_type", "ts", "event_id", "event_id", "next_id", by_range=True)
    return led.select("event_id", "event_type", F.col("next_id").cast("double").alias("next_id"))


@query("largest_events", "AGG4 UDF3", sql=r"""
WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place
           FROM events WHERE value IS NOT NULL)
SELECT event_type, place::BIGINT AS place, event_id, value FROM r WHERE place <= 5
""")
def largest_events(spark, sf_dir):
    """An accumulator that no built-in aggregate has: the five largest events of a type, merged from partial states."""
    ev = sources.table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    top = combine_by_key(ev, "event_type", ["event_id", "value"], Largest(5, "event_id", "value"))
    each = top.select("event_type", F.posexplode(F.arrays_zip("ids", "vals")).alias("at", "x"))
    return each.select("event_type", (F.col("at") + 1).cast("bigint").alias("place"), F.col("x.ids").alias("event_id"), F.col("x.vals").alias("value"))


@query("paged_groups", "AGG5 JON1", sql=r"""
WITH c AS (SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS total_ids FROM events GROUP BY 1),
p AS (SELECT *, unnest(range(0, (n + 499) // 500)) AS page FROM c)
SELECT event_type, page::BIGINT AS page, least(500, n - 500 * page)::BIGINT AS n_values, total_ids FROM p
""")
def paged_groups(spark, sf_dir):
    """The ids of every event type in lists of at most 500; the lists of a type hold all of its ids."""
    pages = group_pages(sources.table(spark, sf_dir, "events"), "event_type", "event_id", 500)
    ids = F.aggregate("values", F.lit(0).cast("bigint"), lambda a, x: a + x)
    total = pages.groupBy("event_type").agg(F.sum(ids).alias("total_ids"))
    return pages.join(total, "event_type").select("event_type", "page", F.size("values").cast("bigint").alias("n_values"), "total_ids")
