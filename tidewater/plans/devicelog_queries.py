"""Device-log queries. Documents of the device-log shape are derived from
``conversations`` (one document per turn); event groups come from ``events``.

Per turn: ``info`` {formatVersion, conv, turn}; ``events``/``monitors``: one
element per text line; ``useractions``: a start record (user turn, with
``name``) or a result record (assistant turn); ``testsuites``: one element;
``campaign``: one element, absent for system turns, whose documents are
therefore rejected (a required section is missing).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources
from ..functions.constants import TRANSFER_ACTION
from ..operators import devicelog as D
from ..operators import ordered
from ..session import ensure_utc
from .registry import query

LONG_TEXT = 100  # user turns at least this long are transfers, shorter ones pauses


def _documents(spark, sf_dir, broken: bool = False):
    """The documents; with ``broken``, every seventh conversation's have a text in place of their events."""
    conv = sources.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    lines = F.split(F.col("text"), "\n")
    ev = F.transform(lines, lambda x, i: F.create_map(
        F.lit("name"), F.col("role"),
        F.lit("tStampMs"), (F.col("turn") * 1000 + i).cast("string"),
        F.lit("evId"), (F.col("conv_id") * 100000 + F.col("turn") * 1000 + i).cast("string"),
        F.lit("len"), F.length(x).cast("string")))
    mon = F.transform(lines, lambda x: F.create_map(
        F.lit("type"), F.when(F.length(x) > 40, F.lit("TPGV")).otherwise(F.lit("TPM")),
        F.lit("dlv"), F.length(x).cast("string")))
    start = F.create_map(F.lit("uniqTcId"), F.col("conv_id").cast("string"),
                         F.lit("name"), F.when(F.length("text") >= LONG_TEXT, F.lit(TRANSFER_ACTION))
                                         .otherwise(F.lit("Pause")),
                         F.lit("evId"), F.col("turn").cast("string"))
    end = F.create_map(F.lit("uniqTcId"), F.col("conv_id").cast("string"),
                       F.lit("result"), F.lit("ok"),
                       F.lit("activeFor"), F.length("text").cast("string"),
                       F.lit("evId"), F.col("turn").cast("string"))
    ua = (F.when(F.col("role") == "user", F.array(start))
           .when(F.col("role") == "assistant", F.array(end))
           .otherwise(F.array().cast("array<map<string,string>>")))
    info = F.create_map(F.lit("formatVersion"), F.lit("1"), F.lit("conv"), F.col("conv_id").cast("string"),
                        F.lit("turn"), F.col("turn").cast("string"))
    ts = F.array(F.create_map(F.lit("conv"), F.col("conv_id").cast("string")))
    camp = F.array(F.create_map(F.lit("exitCriteria"), F.lit('{"time":60}')))
    base = F.struct(info.alias("info"), ev.alias("events"), mon.alias("monitors"),
                    ts.alias("testsuites"), ua.alias("useractions"))
    with_camp = F.struct(info.alias("info"), ev.alias("events"), mon.alias("monitors"),
                         ts.alias("testsuites"), ua.alias("useractions"), camp.alias("campaign"))
    doc = F.when(F.col("role") == "system", F.to_json(base)).otherwise(F.to_json(with_camp))
    if broken:
        oops = F.struct(info.alias("info"), F.lit("oops").alias("events"), mon.alias("monitors"),
                        ts.alias("testsuites"), ua.alias("useractions"), camp.alias("campaign"))
        doc = F.when(F.col("conv_id") % 7 == 0, F.to_json(oops)).otherwise(doc)
    return conv.select("conv_id", "turn", doc.alias("value"))


@query("explode_sections", "RTE2", sql=r"""
WITH a AS (SELECT *, len(string_split(text, chr(10))) AS n_lines,
                  role = 'system' OR conv_id % 7 = 0 AS bad FROM conversations),
c AS (SELECT * FROM a WHERE NOT bad)
SELECT section, n::BIGINT AS n FROM (
  SELECT 'info' AS section, count(*) AS n FROM c
  UNION ALL SELECT 'events', sum(n_lines) FROM c
  UNION ALL SELECT 'monitors', sum(n_lines) FROM c
  UNION ALL SELECT 'testsuites', count(*) FROM c
  UNION ALL SELECT 'useractions', count(*) FROM c WHERE role IN ('user', 'assistant')
  UNION ALL SELECT 'campaign', count(*) FROM c
  UNION ALL SELECT '_rejected', count(*) FROM a WHERE bad
)
""")
def explode_sections(spark, sf_dir):
    parsed = D.parse_documents(_documents(spark, sf_dir, broken=True), keep=["conv_id", "turn"])
    return D.group_sizes(D.sections_long(parsed), "section")


@query("rejected_documents", "RTE2 PRJ6", sql=r"""
SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 THEN 'events' ELSE 'campaign' END AS missing
FROM conversations WHERE role = 'system' OR conv_id % 7 = 0
""")
def rejected_documents(spark, sf_dir):
    """Rejected documents whole, with the reason: ids are read from the kept text."""
    rejected = D.sections_long(D.parse_documents(_documents(spark, sf_dir, broken=True))).where(F.col("section") == "_rejected")
    text = F.col("row")["document"]
    return rejected.select(F.get_json_object(text, "$.info.conv").cast("bigint").alias("conv_id"),
                           F.get_json_object(text, "$.info.turn").cast("bigint").alias("turn"), F.col("row")["missing"].alias("missing"))


def _pairs(spark, sf_dir):
    parsed = D.parse_documents(_documents(spark, sf_dir))
    actions = D.section(D.valid_documents(parsed), "useractions")
    return D.pair_actions(actions)


@query("pair_actions", "AGG5 AGG6 PRJ9", sql=r"""
WITH s AS (SELECT conv_id, arg_max(turn, turn) AS start_ev,
                  arg_max(CASE WHEN length(text) >= 100 THEN 'TestFileTransfer' ELSE 'Pause' END, turn) AS type
           FROM conversations WHERE role = 'user' GROUP BY conv_id),
     r AS (SELECT conv_id, max(turn) AS end_ev, arg_max(length(text), turn) AS active_for
           FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT s.conv_id::VARCHAR AS uniqTcId, s.type, s.start_ev::BIGINT AS start_ev,
       r.end_ev::DOUBLE AS end_ev, r.active_for::DOUBLE AS active_for
FROM s LEFT JOIN r ON s.conv_id = r.conv_id
""")
def pair_actions(spark, sf_dir):
    pairs = D.paired(_pairs(spark, sf_dir))
    return pairs.select("uniqTcId", "type",
                        F.col("parameter")["evId"].cast("bigint").alias("start_ev"),
                        # No result record -> null; nullable numbers as double.
                        F.col("result")["evId"].cast("double").alias("end_ev"),
                        F.col("result")["activeFor"].cast("double").alias("active_for"))


@query("action_groups", "AGG5 AGG9 FLT3", sql=r"""
SELECT type, count(*)::BIGINT AS n
FROM (SELECT conv_id, arg_max(CASE WHEN length(text) >= 100 THEN 'TestFileTransfer' ELSE 'Pause' END, turn) AS type
      FROM conversations WHERE role = 'user' GROUP BY conv_id)
GROUP BY type
""")
def action_groups(spark, sf_dir):
    return D.group_sizes(D.paired(_pairs(spark, sf_dir)), "type")


@query("group_sizes", "AGG9 FLT3", sql=r"""
SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type
""")
def group_sizes(spark, sf_dir):
    ev = sources.table(spark, sf_dir, "events")
    return D.group_sizes(ev, "event_type")


@query("rat_with_actions", "JON5 WIN1 FLT3", sql=r"""
WITH e AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms,
         (lead(epoch_us(ts) // 1000) OVER (ORDER BY ts, event_id))::DOUBLE AS ts_end_ms
  FROM events WHERE event_type = 'error'
), a AS (
  SELECT count(*)::BIGINT AS n_actions, min(epoch_us(ts) // 1000) AS first_action_ms,
         max(epoch_us(ts) // 1000) AS last_action_ms
  FROM events WHERE event_type = 'signup'
)
SELECT e.*, a.* FROM e CROSS JOIN a
""")
def rat_with_actions(spark, sf_dir):
    ensure_utc(spark)
    ev = sources.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rat = D.only_group(ev, "event_type", "error").select(
        "event_id", "event_type", "ts", F.unix_millis("ts").alias("ts_ms"))
    rat = ordered.lead_within(rat, "event_type", "ts", "event_id", None, "ts_end_ms", of_time=F.unix_millis)
    actions = D.only_group(ev, "event_type", "signup")
    out = D.attach_group(rat, actions, [F.count(F.lit(1)).alias("n_actions"),
                                        F.min(F.unix_millis("ts")).alias("first_action_ms"),
                                        F.max(F.unix_millis("ts")).alias("last_action_ms")])
    return out.select("event_id", "ts_ms", F.col("ts_end_ms").cast("double").alias("ts_end_ms"),
                      "n_actions", "first_action_ms", "last_action_ms")
