"""Batch jobs composed from the operators, with a command line.

    python -m tidewater.jobs wordcount --input 'dir/*.txt' --output out/
    python -m tidewater.jobs debugging-wordcount --input f.txt [--pattern 'a|b']
    python -m tidewater.jobs windowed-wordcount --input f.txt --output out/ [--window-minutes 10]
    python -m tidewater.jobs device-log --input log.json --output out/
    python -m tidewater.jobs table-scan --table path.parquet

The streaming ride jobs are in ``tidewater.streaming.jobs``.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks, sources
from .functions.constants import (BATTERY_EVENT, DEFAULT_FILTER_PATTERN, RAT_CHANGE_EVENT,
                                  TRANSFER_ACTION, WORD_WINDOW_MINUTES)
from .functions.text import format_count
from .functions.time import random_event_time
from .operators import checks, cogroup, devicelog, words
from .operators.observe import metrics, observed
from .session import scratch_path


def wordcount(spark: SparkSession, input_glob: str, output: str, keep_apostrophes: bool = False) -> None:
    """Lines -> ``word: n`` text files (one file per task)."""
    counts = words.count_words(sources.read_lines(spark, input_glob), keep_apostrophes=keep_apostrophes)
    sinks.write_text(words.format_counts(counts), output)


def debugging_wordcount(spark: SparkSession, input_glob: str, pattern: str = DEFAULT_FILTER_PATTERN,
                        expected: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """Counts of the words that fully match ``pattern``; optionally checks them
    against ``expected`` (raises on any difference)."""
    counts = words.count_words(sources.read_lines(spark, input_glob))
    kept = words.filter_words(counts, pattern)
    if expected is not None:
        checks.expect_rows(kept, spark.createDataFrame(list(expected), "word string, n long"))
    return kept


def windowed_wordcount(spark: SparkSession, input_glob: str, output: str,
                       window_minutes: int = WORD_WINDOW_MINUTES, min_ms: int | None = None,
                       max_ms: int | None = None, num_shards: int | None = None) -> None:
    """Lines get a random event time in [min, max), words are counted per window
    and written as one set of files per window."""
    lines = sources.read_lines(spark, input_glob).withColumn("ts", random_event_time(min_ms, max_ms))
    counts = words.count_words(lines, extra_keys=[F.window("ts", f"{window_minutes} minutes").alias("window")])
    out = counts.select("window", format_count("word", "n").alias("value"))
    sinks.write_per_window(out, output, "window", "value", num_shards)


def device_log(spark: SparkSession, input_glob: str) -> dict[str, DataFrame]:
    """The device-log analysis: split documents, pair user actions and keep the
    transfer group, battery events, and rate-change events with their end time
    and the transfer group attached (as a one-row summary)."""
    parsed = devicelog.parse_documents(sources.read_lines(spark, input_glob))
    # Every document is parsed once, into a table of its sections' elements; all outputs read from that.
    path = scratch_path(spark, "sections")
    long = devicelog.sections_long(parsed)
    long.write.partitionBy("section").parquet(path)
    long = spark.read.schema(long.schema).parquet(path)

    def section(name):
        return long.where(F.col("section") == name).select("row")
    pairs = devicelog.pair_actions(section("useractions"))
    transfers = devicelog.only_group(devicelog.paired(pairs), "type", TRANSFER_ACTION)
    events = devicelog.event_rows(section("events"))
    battery = devicelog.only_group(events, "name", BATTERY_EVENT)
    rat = devicelog.complete_times(devicelog.only_group(events, "name", RAT_CHANGE_EVENT))
    rat_with_group = devicelog.attach_group(rat, transfers, [F.count(F.lit(1)).alias("n_transfers")])
    return {"rejected_documents": section("_rejected").select(
                F.col("row")["document"].alias("document"), F.split(F.col("row")["missing"], ",").alias("missing")),
            "action_pairs": pairs,
            "transfer_group_sizes": devicelog.group_sizes(transfers, "type"), "battery_events": battery,
            "rat_events": rat_with_group}


def contact_lines(named_inputs: dict[str, DataFrame], key: str = "name", value: str = "value") -> DataFrame:
    """Co-group contact lists: ``NAME k EMAILS : [..] PHONES : [..]`` per key."""
    g = cogroup.cogroup_lists(named_inputs, key, {n: [value] for n in named_inputs})
    parts = [F.lit("NAME "), F.col("key")]
    for n in named_inputs:
        parts += [F.lit(f" {n.upper()} : ["), F.array_join(F.transform(n, lambda s: s[value]), ", "), F.lit("]")]
    return g.select(F.concat(*parts).alias("value"))


def lines_with_side_record(spark: SparkSession, lines: DataFrame, record_glob: str) -> DataFrame:
    """Attach the one JSON record in ``record_glob`` (a side input that must hold
    exactly one row) to every line; rejects undecodable records."""
    from .operators import rows
    parsed = sources.read_lines(spark, record_glob)
    record = rows.good_rows(rows.parse_json(parsed, "value")).select(F.col("row").alias("side"))
    return cogroup.with_singleton(lines, record, "side record")


def table_scan(spark: SparkSession, table: str) -> dict:
    """Whole-table scan with observed counters (rows)."""
    observed(spark.read.parquet(table), "table_scan").write.format("noop").mode("overwrite").save()
    return metrics("table_scan")


def main(argv: Sequence[str] | None = None) -> int:
    from .session import build_session
    ap = argparse.ArgumentParser(prog="tidewater.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("wordcount")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--keep-apostrophes", action="store_true")
    p = sub.add_parser("debugging-wordcount")
    p.add_argument("--input", required=True)
    p.add_argument("--pattern", default=DEFAULT_FILTER_PATTERN)
    p = sub.add_parser("windowed-wordcount")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--window-minutes", type=int, default=WORD_WINDOW_MINUTES)
    p.add_argument("--num-shards", type=int, default=None)
    p = sub.add_parser("device-log")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p = sub.add_parser("table-scan")
    p.add_argument("--table", required=True)
    args = ap.parse_args(argv)
    spark = build_session(app_name=f"tidewater-{args.job}")
    if args.job == "wordcount":
        wordcount(spark, args.input, args.output, args.keep_apostrophes)
    elif args.job == "debugging-wordcount":
        debugging_wordcount(spark, args.input, args.pattern).show(truncate=False)
    elif args.job == "windowed-wordcount":
        windowed_wordcount(spark, args.input, args.output, args.window_minutes, num_shards=args.num_shards)
    elif args.job == "device-log":
        for name, df in device_log(spark, args.input).items():
            df.write.mode("overwrite").json(f"{args.output.rstrip('/')}/{name}")
    elif args.job == "table-scan":
        print(table_scan(spark, args.table))
    return 0


if __name__ == "__main__":
    sys.exit(main())
