"""Structured Streaming queries over the driver's tables.

Each runs a real streaming query to the end (``availableNow``) with a
per-batch sink in the shared folder, then returns the sink's content as a
batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks, sources
from ..operators.observe import StreamMetrics
from ..session import ensure_utc, scratch_path
from ..streaming import jobs
from ..streaming import sources as S
from ..streaming.state import RETRACTED, pane_sums, session_updates
from .registry import query

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _event_stream(spark, path, max_files=None):
    return S.file_stream(spark, path, EVENTS_DDL, "parquet", max_files) \
            .withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_tumbling", "STR1 STR4 STR6 STR8 SRC5 SRC7", sql=r"""
SELECT epoch_ms(date_trunc('minute', ts)) / 1000.0 / 60.0 AS dollar_window,
       round(sum(value), 2) AS dollar_turnover, count(*)::BIGINT AS n
FROM events GROUP BY date_trunc('minute', ts)
""")
def stream_tumbling(spark, sf_dir):
    ensure_utc(spark)
    ev = _event_stream(spark, S.table_files(sf_dir, "events"))
    agg = (ev.withWatermark("ts", "5 minutes")
             .groupBy(F.window("ts", "1 minute").alias("window"))
             .agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
             .select(F.unix_millis("window.start").alias("start_ms"), "total", "n"))
    out, ckpt = scratch_path(spark, "stream_tumbling"), scratch_path(spark, "ckpt")
    jobs.run_available(agg, out, ckpt, "update")
    final = jobs.latest_by_batch(spark, out, ["start_ms"])
    return final.select((F.col("start_ms") / F.lit(1000.0) / F.lit(60.0)).alias("dollar_window"),
                        F.round("total", 2).alias("dollar_turnover"), F.col("n").cast("bigint"))


@query("stream_sessions", "STR3 STR5 STR11 AGG4 UDF3", sql=r"""
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
""")
def stream_sessions(spark, sf_dir):
    """Sessions of the events fed in ``STEPS`` batches that overlap in time by up to half an hour."""
    ensure_utc(spark)
    rows = _events(spark, sf_dir)
    delay = F.pmod(F.xxhash64("event_id"), F.lit(SHUFFLED_MINUTES * 60_000_000))
    feed, out, ckpt = (scratch_path(spark, n) for n in ("session_feed", "stream_sessions", "ckpt"))

    def start():
        upd = session_updates(S.file_stream(spark, jobs.step_files(feed), EVENT_ROW), "user_id", "ts", "event_id",
                              ["event_id", "value"], ["long", "double"], 60, out_of_order_minutes=SHUFFLED_MINUTES)
        return jobs.start_batches(upd, out, ckpt, "update")
    jobs.replay(rows, _step(rows, F.unix_micros("ts") + delay), STEPS, feed, _write, start)
    final = jobs.latest_by_batch(spark, out, ["user_id", "session_start_ms"]).where(F.col("timing") != RETRACTED)
    return final.select("user_id", "session_start_ms", "last_ms", "session_end_ms",
                        F.col("n_events").cast("bigint"),
                        F.col("event_id").alias("latest_event_id"),
                        F.col("value").alias("latest_value"))


# Batches of a replay, whatever the input; minutes by which its events may be out of order.
STEPS, SHUFFLED_MINUTES = 4, 30
EVENT_ROW = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
# Lateness of the pane replay, in minutes: two of its some thirty days, so that late firings and dropped rows occur.
PANE_LATENESS = 2 * 24 * 60


def _events(spark, sf_dir):
    return sources.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _write(rows, path):
    rows.write.parquet(path)


def _step(rows, at):
    """Which of ``STEPS`` equal parts of the events' time span the time ``at`` (in microseconds) falls into."""
    span = rows.agg(F.min(F.unix_micros("ts")).alias("a"), (F.max(F.unix_micros("ts")) + 1).alias("b"))
    low, high = span.select("a").scalar(), span.select("b").scalar()
    return F.least(F.floor((at - low) * STEPS / (high - low)), F.lit(STEPS - 1)).cast("int")


def _pane_step(rows):
    """Events go out in the order of time, but some late: those of the last two days of a step whose
    id is odd, and every tenth of all, come one step later than they belong."""
    us = F.unix_micros("ts")
    on_time, soon = _step(rows, us), _step(rows, us + PANE_LATENESS * 60_000_000)
    late = ((F.col("event_id") % 2 == 1) & (soon > on_time)) | (F.col("event_id") % 10 == 0)
    return F.least(on_time + F.when(late, 1).otherwise(0), F.lit(STEPS - 1))


PANE_ROW = "window_start_ms long, dollar_turnover double, dollar_timing string, pane_index long"
_REPLAYED: dict[tuple[str, str], str] = {}


def _replay_panes(spark, sf_dir) -> str:
    """Replay ``events`` through the pane operator; returns the folder of the JSON sink's files.

    One replay serves all queries of an application over the same table.
    """
    ensure_utc(spark)
    name = (spark.sparkContext.applicationId, sf_dir)
    if name not in _REPLAYED:
        rows = _events(spark, sf_dir)
        feed, out, ckpt = (scratch_path(spark, n) for n in ("pane_feed", "stream_panes", "ckpt"))

        def start():
            panes = pane_sums(S.file_stream(spark, jobs.step_files(feed), EVENT_ROW), "ts", "value", 1, PANE_LATENESS,
                              output_mode="append")
            # Each firing is a new row: append mode straight into the JSON file sink.
            return (panes.writeStream.format("json").outputMode("append").option("path", out)
                         .option("checkpointLocation", ckpt).trigger(**jobs.AT_ONCE).start())
        jobs.replay(rows, _pane_step(rows), STEPS, feed, _write, start)
        _REPLAYED[name] = out
    return _REPLAYED[name]


# The replay in closed form. o: step of each event; m: newest event up to a step (the watermark is two days
# before it); k: what arrives before its window is dropped; t: sums per window after each step with data;
# f: the step after which a window fires on time: the first whose newest event lies past the window's end (or at
# it, if the next step brings the window data), unless the window's first data came later than that.
def _panes_sql(events: str, lateness_us: int, late: str) -> str:
    return f"""
e AS (SELECT event_id, value, epoch_us(ts) AS us, epoch_us(ts) // 60000000 * 60000000 AS w FROM {events}),
r AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) + 1 AS b FROM events),
p AS (SELECT e.*, least(floor((us - a) * 4 / (b - a)), 3) AS s,
             least(floor((us + {lateness_us} - a) * 4 / (b - a)), 3) AS soon FROM e, r),
o AS (SELECT *, least(s + CASE WHEN {late} THEN 1 ELSE 0 END, 3) AS k FROM p),
g AS (SELECT unnest(range(0, 4)) AS k),
m AS (SELECT g.k, max(us) AS newest FROM g LEFT JOIN o ON o.k <= g.k GROUP BY g.k),
kept AS (SELECT o.*, coalesce(prev.newest, 0) AS before FROM o LEFT JOIN m prev ON prev.k = o.k - 1
         WHERE prev.newest IS NULL OR w + 60000000 > prev.newest - {lateness_us}),
d AS (SELECT w, k, any_value(before) AS before, sum(value) AS v FROM kept GROUP BY w, k),
t AS (SELECT w, k, before, sum(v) OVER (PARTITION BY w ORDER BY k) AS total FROM d),
first AS (SELECT w, min(k) AS k0, arg_min(before, k) AS before FROM d GROUP BY w),
f AS (SELECT first.w, min(m.k) AS k FROM first JOIN m ON m.k >= first.k0
        AND (w + 60000000 < m.newest OR (w + 60000000 = m.newest
             AND EXISTS (SELECT 1 FROM d WHERE d.w = first.w AND d.k = m.k + 1)))
      WHERE w + 60000000 > first.before GROUP BY first.w),
panes AS (
  SELECT w, k * 2 + 1 AS place, total,
         CASE WHEN w + 60000000 <= before THEN 'LATE' ELSE 'EARLY' END AS timing FROM t
  UNION ALL
  SELECT f.w, f.k * 2 + 2, arg_max(t.total, t.k), 'ON_TIME' FROM f JOIN t ON t.w = f.w AND t.k <= f.k GROUP BY f.w, f.k)
"""


_PANES_SQL = "WITH " + _panes_sql("events", 172800000000, "(event_id % 2 = 1 AND soon > s) OR event_id % 10 = 0")


@query("stream_panes", "STR4 STR7 STR8 STR9 PRJ12", sql=_PANES_SQL + """
SELECT round(total, 2) AS dollar_turnover, timing AS dollar_timing, w / 60000000.0 AS dollar_window FROM panes
""")
def stream_panes(spark, sf_dir):
    """Every pane firing of the replayed event stream (EARLY / ON_TIME / LATE)."""
    back = spark.read.schema(PANE_ROW).json(_replay_panes(spark, sf_dir))
    return back.select(F.round("dollar_turnover", 2).alias("dollar_turnover"), "dollar_timing",
                       (F.col("window_start_ms") / F.lit(60000.0)).alias("dollar_window"))


@query("stream_panes_final", "STR8 STR9", sql=_PANES_SQL + """
SELECT w / 60000000.0 AS dollar_window, round(arg_max(total, place), 2) AS dollar_turnover FROM panes GROUP BY w
""")
def stream_panes_final(spark, sf_dir):
    """The last firing per window of the replayed stream: the sum of all that was not dropped as too late."""
    back = spark.read.schema(PANE_ROW).json(_replay_panes(spark, sf_dir))
    last = back.groupBy("window_start_ms").agg(F.max_by("dollar_turnover", "pane_index").alias("total"))
    return last.select((F.col("window_start_ms") / F.lit(60000.0)).alias("dollar_window"),
                       F.round("total", 2).alias("dollar_turnover"))


# Ride messages made of events: the payload's time disagrees with the message's, and some payloads are broken,
# lack a ride, a meter or a time, or have text that is no number or no time.
def _ride_messages(spark, sf_dir):
    ev = _events(spark, sf_dir)
    i = F.col("event_id")
    payload_us = F.unix_micros("ts") + F.pmod(i * 7919, F.lit(3600)) * 1_000_000 - 1_800_000_000
    time = F.date_format(F.timestamp_micros(payload_us), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    fields = {"ride_id": F.when(i % 11 != 0, F.concat(F.lit("r"), "user_id")),
              "latitude": F.col("value"), "longitude": -F.col("value"),
              "timestamp": F.when(i % 13 == 0, F.lit("yesterday")).when(i % 17 != 0, time),
              "meter_increment": F.when(i % 19 == 0, F.lit("n/a")).when(i % 23 != 0, F.col("value").cast("string")),
              "ride_status": F.when(i % 3 != 0, F.col("event_type")), "passenger_count": F.lit("1")}
    text = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    payload = F.when(i % 29 == 0, F.expr("left(j, length(j) - 1)")).otherwise(F.col("j"))
    return ev.withColumn("j", text).select("event_id", "ts", payload.alias("payload"))


def _run_ride_job(spark, sf_dir, start, shuffled: bool = False) -> None:
    """Feed the ride messages in ``STEPS`` batches to a job, which ``start(messages)`` starts on a checkpoint of its own."""
    ensure_utc(spark)
    rows = _ride_messages(spark, sf_dir)
    feed = scratch_path(spark, "ride_feed")
    at = F.unix_micros("ts")
    if shuffled:
        at = at + F.pmod(F.xxhash64("event_id"), F.lit(SHUFFLED_MINUTES * 60_000_000))

    def write(part, path):
        part.select("ts", "payload").write.json(path)
    jobs.replay(rows, _step(rows, at), STEPS, feed, write, lambda: start(S.message_stream(spark, jobs.step_files(feed))))


_RIDES_SQL = """
m AS (SELECT event_id, ts, epoch_us(ts) AS us, value, event_type,
        CASE WHEN event_id % 11 <> 0 THEN 'r' || user_id END AS ride_id,
        CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL
             ELSE (epoch_us(ts) + (event_id * 7919 % 3600) * 1000000 - 1800000000) // 1000 END AS t_ms,
        event_id % 29 = 0 AS broken FROM events)
"""


@query("ride_turnover", "SRC5 PRJ7 PRJ11 STR1 STR8 STR9 STR10 SNK6", sql="WITH " + _RIDES_SQL.replace("m AS (", "rides AS (") + ", "
       + _panes_sql("(SELECT * FROM rides WHERE NOT broken AND event_id % 19 <> 0 AND event_id % 23 <> 0)", 300000000, "false") + """
SELECT round(total, 2) AS dollar_turnover, timing AS dollar_timing, w / 60000000.0 AS dollar_window FROM panes
""")
def ride_turnover(spark, sf_dir):
    """Messages -> meter values -> panes -> JSON lines: every firing with its label, as it stands in the published lines."""
    out, ckpt = scratch_path(spark, "turnover"), scratch_path(spark, "ckpt")
    _run_ride_job(spark, sf_dir, lambda m: jobs.start_turnover(m, out, ckpt, jobs.AT_ONCE, early_seconds=0))
    back = spark.read.schema("dollar_turnover double, dollar_timing string, dollar_window double").json(out)
    return back.withColumn("dollar_turnover", F.round("dollar_turnover", 2))


@query("ride_rejects", "PRJ6 PRJ7 PRJ9 PRJ11", sql="WITH " + _RIDES_SQL + """
SELECT branch, reason, count(*)::BIGINT AS n FROM (
  SELECT 'turnover' AS branch, CASE WHEN broken THEN 'undecodable' WHEN event_id % 19 = 0 THEN 'bad_meter'
    WHEN event_id % 23 = 0 THEN 'no_meter' END AS reason FROM m
  UNION ALL
  SELECT 'positions', CASE WHEN broken THEN 'undecodable' WHEN ride_id IS NULL THEN 'no_ride_id'
    WHEN t_ms IS NULL THEN 'bad_time' END FROM m)
WHERE reason IS NOT NULL GROUP BY branch, reason
""")
def ride_rejects(spark, sf_dir):
    out, ckpt = scratch_path(spark, "rejects"), scratch_path(spark, "ckpt")
    _run_ride_job(spark, sf_dir, lambda m: jobs.start_rejects(m, out, ckpt, jobs.AT_ONCE))
    back = spark.read.schema("ts timestamp, branch string, reason string, message string").json(out)
    return back.groupBy("branch", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("ride_positions", "SRC5 PRJ7 PRJ13 AGG4 STR3 STR5 STR11 SNK3 SNK5", sql="WITH " + _RIDES_SQL + """,
e AS (SELECT *, lag(us) OVER (PARTITION BY ride_id ORDER BY us, event_id) AS prev
      FROM m WHERE NOT broken AND ride_id IS NOT NULL AND t_ms IS NOT NULL),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR us // 1000 - prev // 1000 >= 3600000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY ride_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM e),
l AS (SELECT ride_id, min(us) // 1000 AS session_start_ms, max(t_ms) AS t_ms, arg_max(value, t_ms) AS v,
        arg_max(CASE WHEN event_id % 3 <> 0 THEN event_type ELSE '-' END, t_ms) AS status FROM s GROUP BY ride_id, sid)
SELECT ride_id, session_start_ms, t_ms, round(v, 2) AS lat, round(-v, 2) AS lon, nullif(status, '-') AS status,
       status <> '-' AS in_table FROM l
""")
def ride_positions(spark, sf_dir):
    """Messages, out of order, -> sessions by message time -> point of the latest payload time -> log of upserts."""
    out, ride_table, ckpt = (scratch_path(spark, n) for n in ("positions", "ride_table", "ckpt"))
    _run_ride_job(spark, sf_dir, lambda m: jobs.start_positions(
        m, out, ride_table, ckpt, jobs.AT_ONCE, SHUFFLED_MINUTES, early_seconds=0), shuffled=True)
    last = jobs.latest_rows(sinks.read_table(spark, out).drop("day"), ["ride_id", "session_start_ms"])
    point = F.from_json("value", "lat double, lon double, timestamp string, ride_status string").alias("p")
    found = last.where(F.col("timing") != RETRACTED).select("ride_id", "session_start_ms", point).select(
        "ride_id", "session_start_ms", F.unix_millis(F.to_timestamp("p.timestamp")).alias("t_ms"),
        F.round("p.lat", 2).alias("lat"), F.round("p.lon", 2).alias("lon"), F.col("p.ride_status").alias("status"))
    # The ride table has the same point of every session whose point has a status.
    rows = sinks.read_table(spark, ride_table).select(
        "ride_id", F.unix_millis("timestamp").alias("t_ms"), F.round("latitude", 2).alias("lat"),
        F.round("longitude", 2).alias("lon"), F.col("ride_status").alias("status")).distinct()
    marked = rows.withColumn("in_table", F.lit(True))
    return found.join(marked, ["ride_id", "t_ms", "lat", "lon", "status"], "left").select(
        *found.columns, F.coalesce("in_table", F.lit(False)).alias("in_table"))


@query("stream_lines", "SRC6 SRC7", sql=r"""
SELECT count(*)::BIGINT AS n_lines, sum(length(line))::BIGINT AS total_len
FROM (SELECT unnest(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS line FROM documents)
""")
def stream_lines(spark, sf_dir):
    """Lines of an append-only topic, admitted in batches of a bounded number of messages."""
    docs = sources.table(spark, sf_dir, "documents").select("text")
    topic, positions = scratch_path(spark, "lines_topic"), scratch_path(spark, "lines_positions")
    lines = sources.lines_of(docs, "text")
    lines.write.text(topic)
    most = -(-spark.read.text(topic).count() // STEPS)
    out, ckpt = scratch_path(spark, "lines_out"), scratch_path(spark, "ckpt")
    passed = S.log_stream(spark, topic, positions, max(most, 1)).withColumn("value", F.col("value").cast("string"))
    q = (passed.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
               .outputMode("append").trigger(**jobs.AT_ONCE).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    back = spark.read.schema(passed.schema).parquet(out)
    return back.agg(F.count(F.lit(1)).alias("n_lines"),
                    F.sum(F.length("value")).cast("bigint").alias("total_len"))


@query("stream_line_metrics", "AGG7 AGG8 SNK7 SRC6", sql=r"""
WITH l AS (SELECT unnest(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS line FROM documents)
SELECT count(*)::BIGINT AS n_lines, count(*) FILTER (trim(line, ' ') = '')::BIGINT AS empty_lines,
       sum(length(line))::BIGINT AS total_len, min(length(line))::BIGINT AS least, max(length(line))::BIGINT AS most FROM l
""")
def stream_line_metrics(spark, sf_dir):
    """Counters and the distribution of line lengths of a running stream, added up over its batches by a listener."""
    docs = sources.table(spark, sf_dir, "documents").select("doc_id", "text")
    feed, ckpt = scratch_path(spark, "lines_feed"), scratch_path(spark, "ckpt")
    seen = StreamMetrics(f"lines-{feed.rsplit('-', 1)[-1]}")
    ddl = "n_lines bigint, empty_lines bigint, total_len bigint, least bigint, most bigint"
    running = []

    def write(part, path):
        sources.lines_of(part.select("text"), "text").write.text(path)

    def start():
        size = F.length("value").cast("bigint")
        lines = S.string_stream(spark, topic=jobs.step_files(feed)).observe(
            seen.name, F.count(F.lit(1)).alias("n_lines"), F.count_if(F.trim("value") == "").alias("empty_lines"),
            F.sum(size).alias("total_len"), F.min(size).alias("least"), F.max(size).alias("most"))
        running.append(lines.writeStream.format("noop").option("checkpointLocation", ckpt).trigger(**jobs.AT_ONCE).start())
        return running[0]
    spark.streams.addListener(seen)
    try:
        jobs.replay(docs, F.pmod(F.xxhash64("doc_id"), F.lit(STEPS)), STEPS, feed, write, start)
        seen.wait_for(running[0])
    finally:
        spark.streams.removeListener(seen)
    return seen.table(spark, ddl).agg(*[f(c).alias(c) for f, c in (
        (F.sum, "n_lines"), (F.sum, "empty_lines"), (F.sum, "total_len"), (F.min, "least"), (F.max, "most"))])
