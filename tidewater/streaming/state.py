"""Stateful streaming operators as row-wise ``transformWithState`` processors with typed state and event-time timers.

Pane timing (EARLY / ON_TIME / LATE) for tumbling-window sums with allowed
lateness, and gap sessions per key that report changes early and close
on time. Spark's watermark is ``max(event time) - delay``.

Panes, with lateness L and watermark delay L: a window's end is passed when
``wm + L >= end`` and the window is dropped when ``wm >= end``.
Sessions, with watermark delay = gap (and the source's disorder, if any): an event is
too late when ``ts <= wm`` and a session is complete when ``wm >= last_ts``.

Early firings come ``early_seconds`` of processing time after the first element that has not been reported; 0 is one
firing per micro-batch. What is due is fired by the first micro-batch that runs afterwards and has data for
the key or moves the watermark.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.constants import EARLY, LATE, ON_TIME
from ..session import ship_package

# Arrow -> pandas concat of empty group batches warns on every call in workers.
warnings.filterwarnings("ignore", category=FutureWarning, message=".*concatenation with empty.*")

#: A session row that takes back an earlier one, whose start has moved.
RETRACTED = "RETRACTED"

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PANE_OUT = "window_start_ms long, dollar_turnover double, dollar_timing string, pane_index long"
PANE_STATE = "start array<long>, total array<double>, fired array<boolean>, panes array<long>, due array<long>"
#: Neighbouring windows under one state key.
PANES_PER_KEY = 256
#: Buckets of keys whose sessions share a state key: what a state key costs a batch is paid this often at most. Fixed for the
#: life of a checkpoint.
KEY_BUCKETS = 1 << 10
NOT_DUE = -1


def _stateful(spark: SparkSession) -> None:
    """Python workers need the package, and these operators the state store that has column families.

    The process that prepares a processor on the driver does not see shipped files, so this module's classes travel by value.
    """
    ship_package(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class PaneSums(StatefulProcessor):
    """Some neighbouring windows: of each its sum, whether it has fired on time or late, its number of firings, and when
    an early one is due. One row of typed columns, so a key costs one read and one write a batch; one timer, for what comes first."""

    Pane = Row("window_start_ms", "dollar_turnover", "dollar_timing", "pane_index")

    def __init__(self, size_ms: int, lateness_ms: int, early_ms: int):
        self.size, self.lateness, self.early = size_ms, lateness_ms, early_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.panes = handle.getValueState("panes", PANE_STATE)

    def handleInputRows(self, key, rows, timerValues):
        added: dict[int, float] = {}
        for r in rows:
            added[r.start_ms] = added.get(r.start_ms, 0.0) + r.value
        yield from self._advance(added, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._advance({}, timerValues)

    def _advance(self, added: dict[int, float], times):
        wm, now = times.getCurrentWatermarkInMs(), times.getCurrentProcessingTimeInMs()
        held = {start: rest for start, *rest in zip(*(self.panes.get() or ()))}
        kept, timers = [], []
        for start in sorted(held.keys() | added.keys()):
            end, was, new = start + self.size, held.get(start), added.get(start)
            passed = wm + self.lateness >= end
            total, fired, panes, due = was or (0.0, False, 0, NOT_DUE)
            if was and passed and not fired:
                yield self.Pane(start, total, ON_TIME, panes)
                fired, panes, due = True, panes + 1, NOT_DUE
            if wm >= end:
                continue  # Dead window (past the allowed lateness): forgotten; its late data is dropped.
            total += new or 0.0
            if passed and new is not None:
                yield self.Pane(start, total, LATE, panes)
                fired, panes = True, panes + 1
            elif not passed:
                if new is not None and due == NOT_DUE:
                    due = now + self.early
                if due != NOT_DUE and now >= due:
                    yield self.Pane(start, total, EARLY, panes)
                    panes, due = panes + 1, NOT_DUE
            kept.append((start, total, fired, panes, due))
            timers.append(wm + 1 if due != NOT_DUE else end if fired else end - self.lateness)
        if kept:
            self.panes.update(tuple(map(list, zip(*kept))))
            self.handle.registerTimer(min(timers))
        elif held:
            self.panes.clear()

    def close(self) -> None:
        pass


def _partial_sums(size_ms: int):
    """Map-side combine: one (max_ts, sum) per window and task."""
    def combined(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(parts).groupby("w", as_index=False, sort=False).agg({"ts": "max", "value": "sum"})

    def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, rows, held = [], 0, 0
        for pdf in it:
            pdf = pdf[pdf["ts"].notna()]  # no time, no window
            if pdf.empty:
                continue
            ms = pdf["ts"].astype("datetime64[us]").astype("int64") // 1000
            parts.append(combined([pdf.assign(w=ms // size_ms)]))
            rows += len(parts[-1])
            if rows > 2 * held + 100_000:  # each row is merged a bounded number of times
                parts = [combined(parts)]
                rows = held = len(parts[0])
        if parts:
            yield combined(parts).rename(columns={"ts": "max_ts", "value": "s"})[["max_ts", "s"]]
    return fn


def pane_sums(stream: DataFrame, ts: str = "ts", value: str = "value", size_minutes: int = 1,
              lateness_minutes: int = 5, combine: bool = True, output_mode: str = "update",
              early_seconds: float = 0) -> DataFrame:
    """Per tumbling window, an accumulating sum with a pane label per firing.

    Output: window_start_ms, dollar_turnover, dollar_timing, pane_index (0, 1, ..
    per window, in firing order). Every firing is a new row, so the query may
    run in ``append`` mode (file sinks) or ``update`` mode. With ``combine`` a
    stateless map-side sum runs first, so a window costs one row per task. State
    is a typed row per open window.
    """
    _stateful(stream.sparkSession)
    size_ms = size_minutes * 60_000
    lat_ms = lateness_minutes * 60_000
    src = stream.select(F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"))
    if combine:
        src = src.mapInPandas(_partial_sums(size_ms), "max_ts timestamp, s double") \
                 .select(F.col("max_ts").alias("ts"), F.col("s").alias("value"))
    wm = src.withWatermark("ts", f"{lateness_minutes} minutes")
    # Only the window (not ts) goes into the state function: late-row filtering
    # then uses the window's end, which is the lateness rule wanted.
    keyed = wm.select(F.window("ts", f"{size_minutes} minutes").alias("w"), "value") \
              .select(F.unix_millis(F.col("w.start")).alias("start_ms"), "w", "value") \
              .withColumn("windows", F.floor(F.col("start_ms") / (size_ms * PANES_PER_KEY)))
    return keyed.groupBy("windows").transformWithState(
        PaneSums(size_ms, lat_ms, int(early_seconds * 1000)), PANE_OUT, output_mode, "EventTime")


class SessionUpdates(StatefulProcessor):
    """The open sessions of a bucket of keys as pages of typed columns; one timer, for the session that is complete first.

    A call to the state store and each row kept in it cost far more than an event, and both grow with the number of keys
    if every key has its own state. So a bucket costs one read and one write a batch, and a page is one row.
    Only keys with new events are merged and reported before the timer.
    """

    LONGS = ("start", "end", "n", "seen", "sort", "tiebreak", "due")
    CHUNK = 1 << 14
    #: Sessions in one row of the state.
    PAGE = 1 << 10

    def __init__(self, gap_ms: int, point: Sequence[str], point_ddl: Sequence[str], early_ms: int, out_cols: Sequence[str],
                 key_ddl: str = "string"):
        self.gap, self.early, self.points = gap_ms, early_ms, [f"p{i}" for i in range(len(point))]
        self.page_ddl = ", ".join([f"key array<{key_ddl}>", *[f"{c} array<long>" for c in self.LONGS], "shown array<array<long>>",
                                   *[f"{p} array<{t}>" for p, t in zip(self.points, point_ddl)]])
        self.out_cols = list(out_cols)

    def init(self, handle) -> None:
        self.handle = handle
        self.pages = handle.getListState("pages", self.page_ddl)
        self.Out = Row(*self.out_cols)

    def handleInputRows(self, key, rows, timerValues):
        wm, now = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs()
        fresh: dict = {}
        seen = now << 20  # orders the events by arrival, over batches too
        while chunk := list(islice(rows, self.CHUNK)):
            # Sessions merge as a union of intervals, so memory is one chunk plus the open sessions.
            touched = set()
            for i, r in enumerate(chunk):
                if r.ms > wm:  # the rest is late and dropped
                    touched.add(r.key)
                    fresh.setdefault(r.key, []).append({
                        "start": r.ms, "end": r.ms + self.gap, "n": 1, "seen": seen + i, "best": (r.sort, -r.tiebreak),
                        "point": [r[p] for p in self.points], "due": now + self.early, "shown": []})
            for k in touched:
                fresh[k] = self._union(fresh[k])
            seen += len(chunk)
        if fresh:
            opened = self._read()
            for k, new in fresh.items():
                opened[k] = self._union(opened.get(k, []) + new)
                for s in opened[k]:
                    yield from self._report_if_due(k, s, now)
            self._write(opened, wm)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm, now = timerValues.getCurrentWatermarkInMs(), timerValues.getCurrentProcessingTimeInMs()
        opened, rest = self._read(), {}
        for k, sessions in opened.items():
            for s in sessions:
                if wm >= s["end"] - self.gap:
                    yield from self._retract(k, s)
                    yield self._row(k, s, s["start"], s["n"], ON_TIME)
                else:
                    yield from self._report_if_due(k, s, now)
                    rest.setdefault(k, []).append(s)
        if opened:
            self._write(rest, wm)

    def _union(self, sessions: list[dict]) -> list[dict]:
        """Merge half-open intervals that overlap; touching ones stay apart."""
        sessions.sort(key=lambda s: (s["start"], s["end"]))
        merged: list[dict] = []
        for s in sessions:
            if not merged or s["start"] >= merged[-1]["end"]:
                merged.append(s)
                continue
            m = merged[-1]
            first, second = (m, s) if m["seen"] <= s["seen"] else (s, m)
            top = second if second["best"] > first["best"] else first  # the first seen stays among equals
            due = [x["due"] for x in (m, s) if x["due"] != NOT_DUE]
            merged[-1] = {"start": m["start"], "end": max(m["end"], s["end"]), "n": m["n"] + s["n"], "seen": first["seen"],
                          "best": top["best"], "point": top["point"], "due": min(due) if due else NOT_DUE,
                          "shown": m["shown"] + s["shown"]}
        return merged

    def _report_if_due(self, key, s: dict, now: int):
        if s["due"] != NOT_DUE and now >= s["due"]:
            yield from self._retract(key, s)
            yield self._row(key, s, s["start"], s["n"], EARLY)
            s["shown"], s["due"] = [s["start"]], NOT_DUE

    def _retract(self, key, s: dict):
        """A start that moved: take back what was reported under the old one."""
        for old in sorted(set(s["shown"]) - {s["start"]}):
            yield self._row(key, s, old, 0, RETRACTED)

    def _row(self, key, s: dict, start: int, n: int, timing: str) -> Row:
        return self.Out(key, start, s["end"], s["end"] - self.gap, n, *s["point"], timing)

    def _read(self) -> dict:
        """The open sessions by key."""
        opened: dict = {}
        for keys, start, end, n, seen, sort, tiebreak, due, shown, *points in self.pages.get():
            for i, k in enumerate(keys):
                opened.setdefault(k, []).append({
                    "start": start[i], "end": end[i], "n": n[i], "seen": seen[i], "best": (sort[i], -tiebreak[i]), "due": due[i],
                    "shown": list(shown[i]), "point": [p[i] for p in points]})
        return opened

    def _write(self, opened: dict, wm: int) -> None:
        if not opened:
            self.pages.clear()
            return
        rows = [(k, s["start"], s["end"], s["n"], s["seen"], s["best"][0], -s["best"][1], s["due"], s["shown"], *s["point"])
                for k, sessions in opened.items() for s in sessions]
        self.pages.put([tuple(map(list, zip(*rows[i:i + self.PAGE]))) for i in range(0, len(rows), self.PAGE)])
        pending = any(s["due"] != NOT_DUE for sessions in opened.values() for s in sessions)
        first = min(s["end"] for sessions in opened.values() for s in sessions)
        self.handle.registerTimer(wm + 1 if pending else first - self.gap)

    def close(self) -> None:
        pass


def session_updates(stream: DataFrame, key: str, ts: str, tiebreak: str | None, point: Sequence[str],
                    point_ddl: Sequence[str], gap_minutes: int = 60, order_by: str | None = None,
                    out_of_order_minutes: int = 0, early_seconds: float = 0) -> DataFrame:
    """Per key, gap sessions with early rows: every changed session as EARLY,
    every completed one as ON_TIME (then forgotten). Zero allowed lateness.

    Output: key, session_start_ms, session_end_ms, last_ms, n_events, <point>, timing.
    Sessions form by the event time ``ts``. The point reported is the one of largest
    ``order_by`` (a number; by default the event time); on ties the smaller ``tiebreak``
    (a number, if given), then the first seen. When an earlier event moves
    a session's start, a RETRACTED row takes back the start reported before.

    ``out_of_order_minutes`` is how far the source's events may lag behind the
    newest one without being late. State is typed columns of the open sessions of ``KEY_BUCKETS`` buckets of keys.
    """
    _stateful(stream.sparkSession)
    gap_ms = gap_minutes * 60_000
    cols = [key, "session_start_ms", "session_end_ms", "last_ms", "n_events", *point, "timing"]
    key_type = dict(stream.dtypes)[key]
    out_ddl = ", ".join([f"{key} {key_type}", "session_start_ms long", "session_end_ms long",
                         "last_ms long", "n_events long", *[f"{p} {t}" for p, t in zip(point, point_ddl)],
                         "timing string"])
    order = F.col(order_by).cast("long") if order_by else F.unix_micros(F.col(ts))
    src = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & order.isNotNull()) \
                .select(F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int").alias("bucket"), F.col(key).alias("key"), F.col(ts).alias("ts"), F.unix_millis(F.col(ts)).alias("ms"), order.alias("sort"),
                        (F.coalesce(F.col(tiebreak).cast("long"), F.lit(0)) if tiebreak else F.lit(0)).cast("long").alias("tiebreak"),
                        *[F.col(p).alias(f"p{i}") for i, p in enumerate(point)]) \
                .withWatermark("ts", f"{gap_minutes + out_of_order_minutes} minutes")
    return src.groupBy("bucket").transformWithState(
        SessionUpdates(gap_ms, point, point_ddl, int(early_seconds * 1000), cols, key_type), out_ddl, "update", "EventTime")
