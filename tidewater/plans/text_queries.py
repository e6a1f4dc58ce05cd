"""Word-count family queries over ``documents`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks, sources
from ..functions.constants import WORD_WINDOW_MINUTES
from ..functions.time import digest_event_time, hashed_event_time
from ..operators import words as W
from ..session import ensure_utc, scratch_path
from .registry import query

# A pattern that hits words of the generated prose; full match, so `qu\p{L}*`
# must not match inside "ayqueb" and `the` must not match "there".
QUERY_FILTER_PATTERN = r"the|qu\p{L}*|und"


def _documents(spark, sf_dir, *cols):
    """The columns needed from ``documents``."""
    return sources.table(spark, sf_dir, "documents").select(*cols)


@query("word_count", "PRJ1 AGG1 AGG2 SRC4", sql=r"""
SELECT word, count(*)::BIGINT AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""")
def word_count(spark, sf_dir):
    return W.count_words(_documents(spark, sf_dir, "text"), "text")


@query("word_filter", "FLT1 AGG7", sql=r"""
SELECT word, count(*)::BIGINT AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM documents)
WHERE word <> '' AND regexp_full_match(word, 'the|qu\p{L}*|und')
GROUP BY word
""")
def word_filter(spark, sf_dir):
    return W.filter_words(W.count_words(_documents(spark, sf_dir, "text"), "text"), QUERY_FILTER_PATTERN)


@query("word_filter_metrics", "FLT1 AGG7", sql=r"""
SELECT count(*) FILTER (WHERE regexp_full_match(word, 'the|qu\p{L}*|und'))::BIGINT AS matched_words,
       count(*) FILTER (WHERE NOT regexp_full_match(word, 'the|qu\p{L}*|und'))::BIGINT AS unmatched_words
FROM (SELECT DISTINCT word FROM
      (SELECT unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM documents)
      WHERE word <> '')
""")
def word_filter_metrics(spark, sf_dir):
    return W.filter_metrics(W.count_words(_documents(spark, sf_dir, "text"), "text"), QUERY_FILTER_PATTERN)


@query("format_counts", "PRJ3", sql=r"""
SELECT word || ': ' || CAST(count(*) AS VARCHAR) AS value
FROM (SELECT unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""")
def format_counts(spark, sf_dir):
    return W.format_counts(W.count_words(_documents(spark, sf_dir, "text"), "text"))


@query("line_stats", "AGG7 AGG8", sql=r"""
SELECT lang,
       count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE regexp_full_match(line, '[\x00-\x20]*'))::BIGINT AS empty_lines,
       sum(length(line))::BIGINT AS sum_len,
       min(length(line))::BIGINT AS min_len,
       max(length(line))::BIGINT AS max_len
FROM (SELECT lang, unnest(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS line
      FROM documents)
GROUP BY lang
""")
def line_stats(spark, sf_dir):
    docs = _documents(spark, sf_dir, "text", "lang")
    return W.line_metrics(sources.lines_of(docs, "text", keep=["lang"]), keys=["lang"])


@query("two_lengths", "PRJ4 PRJ5", sql=r"""
SELECT c_custkey, c_name AS value, length(c_name)::BIGINT AS len,
       length(replace(c_name, ' ', ''))::BIGINT AS len_nospace
FROM customer
""")
def two_lengths(spark, sf_dir):
    cust = sources.table(spark, sf_dir, "customer").withColumnRenamed("c_name", "value")
    return W.line_lengths(cust, "value", keep=["c_custkey"])


# Documents get a deterministic event time inside one hour from their id, then
# words are counted per 10-minute window (window start as epoch ms).
WINDOWED_BASE_MS = 1_704_067_200_000  # 2024-01-01T00:00:00Z
WINDOWED_SPAN_MS = 3_600_000


@query("windowed_words", "STR1 STR2 STR12", sql=r"""
WITH d AS (
  SELECT text, 1704067200000 + ((doc_id * 7919) % 3600000) AS ts_ms FROM documents
)
SELECT (ts_ms // 600000) * 600000 AS window_start_ms, word, count(*)::BIGINT AS n
FROM (SELECT ts_ms, unnest(regexp_split_to_array(text, '[^\p{L}]+')) AS word FROM d)
WHERE word <> ''
GROUP BY ALL
""")
def windowed_words(spark, sf_dir):
    ensure_utc(spark)
    docs = _documents(spark, sf_dir, "doc_id", "text")
    ts = F.timestamp_millis(F.lit(WINDOWED_BASE_MS) + F.pmod(F.col("doc_id") * 7919, F.lit(WINDOWED_SPAN_MS)))
    timed = docs.select("text", ts.alias("ts"))
    win = F.window("ts", f"{WORD_WINDOW_MINUTES} minutes")
    counts = W.count_words(timed, "text", extra_keys=[win.alias("window")])
    return counts.select(F.unix_millis(F.col("window.start")).alias("window_start_ms"), "word", "n")


@query("apostrophe_words", "PRJ2 AGG1", sql=r"""
SELECT word, count(*)::BIGINT AS n
FROM (SELECT unnest(regexp_extract_all(replace(text, ' the ', ' the''s '), '[\p{L}'']+')) AS word FROM documents)
GROUP BY word
""")
def apostrophe_words(spark, sf_dir):
    """Words with apostrophes kept (the texts have none, so some are put in)."""
    docs = _documents(spark, sf_dir, F.replace("text", F.lit(" the "), F.lit(" the's ")).alias("text"))
    return W.tokenize(docs, "text", keep_apostrophes=True).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("text_round_trip", "SRC1 SNK1", sql=r"""
SELECT value, count(*)::BIGINT AS n
FROM (SELECT unnest(string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')) AS value FROM documents)
GROUP BY value
""")
def text_round_trip(spark, sf_dir):
    """Lines written by the text sink and read back by a glob."""
    path = scratch_path(spark, "lines")
    sinks.write_text(sources.lines_of(_documents(spark, sf_dir, "text"), "text"), path)
    return sources.read_lines(spark, f"{path}/part-*").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("json_lines_rejects", "SRC2 PRJ6", sql=r"""
SELECT event_id % 5 = 0 AS rejected, count(*)::BIGINT AS n,
       sum(CASE WHEN event_id % 5 <> 0 THEN event_id END)::BIGINT AS sum_id FROM events GROUP BY 1
""")
def json_lines_rejects(spark, sf_dir):
    """JSON lines read from files, every fifth one cut short."""
    ev = sources.table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("j"))
    path = scratch_path(spark, "json_lines")
    cut = F.when(F.col("event_id") % 5 == 0, F.expr("left(j, length(j) - 1)")).otherwise(F.col("j"))
    ev.select(cut.alias("value")).write.text(path)
    parsed = sources.read_json_lines(spark, path, "event_id bigint, event_type string")
    bad = F.col("_corrupt").isNotNull()
    return parsed.groupBy(bad.alias("rejected")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(~bad, F.col("row.event_id"))).alias("sum_id"))


@query("hashed_times", "PRJ14", sql=r"""
SELECT count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS ids, count(*)::BIGINT AS inside FROM documents
""")
def hashed_times(spark, sf_dir):
    """Event times drawn by a hash: inside their span for every row, and the same when drawn again."""
    ensure_utc(spark)
    docs = _documents(spark, sf_dir, "doc_id")
    low, high = WINDOWED_BASE_MS, WINDOWED_BASE_MS + WINDOWED_SPAN_MS
    ms = F.unix_millis(hashed_event_time(low, high, "doc_id"))
    inside = (ms >= low) & (ms < high) & (ms == F.unix_millis(hashed_event_time(low, high, F.col("doc_id"))))
    return docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"),
                    F.count(F.when(inside, 1)).alias("inside"))


@query("digest_times", "PRJ14 STR1", sql=f"""
SELECT doc_id, {WINDOWED_BASE_MS} + ('0x' || left(md5(doc_id::VARCHAR || chr(31) || coalesce(lang, '')), 13))::BIGINT % {WINDOWED_SPAN_MS} AS ts_ms
FROM documents
""")
def digest_times(spark, sf_dir):
    """The event time that every document draws, value by value."""
    ensure_utc(spark)
    docs = _documents(spark, sf_dir, "doc_id", "lang")
    drawn = digest_event_time(WINDOWED_BASE_MS, WINDOWED_BASE_MS + WINDOWED_SPAN_MS, "doc_id", "lang")
    return docs.select("doc_id", F.unix_millis(drawn).alias("ts_ms"))
