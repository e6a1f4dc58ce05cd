"""Golden micro-batch sequences for pane labels (G1, G2) and early session rows (G3).

One JSON file per micro-batch, file times in order, maxFilesPerTrigger=1.
Rows are compared per key in batch order (order inside a batch is free).
"""

import json
import os

import pytest

from pyspark.sql import functions as F

from tidewater import sinks
from tidewater.streaming import jobs
from tidewater.streaming.state import pane_sums, session_updates

DAY = "2024-01-01T"
RANK = {"ON_TIME": 0, "EARLY": 1, "LATE": 1}


def _run(spark, tmp, batches, schema, build):
    src = os.path.join(tmp, "src")
    os.makedirs(src)
    for i, rows in enumerate(batches):
        p = os.path.join(src, f"b{i:03d}.json")
        with open(p, "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")
        os.utime(p, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    out = os.path.join(tmp, "out")
    jobs.run_available(build(stream), out, os.path.join(tmp, "ckpt"))
    return spark.read.parquet(out)


def _panes(spark, tmp, batches, combine=True):
    rows = [[{"ts": DAY + t, "value": v} for t, v in b] for b in batches]
    got = _run(spark, tmp, rows, "ts timestamp, value double",
               lambda s: pane_sums(s, "ts", "value", 1, 5, combine=combine))
    per_key = {}
    ordered = sorted(got.collect(), key=lambda r: (r.batch_id, RANK[r.dollar_timing]))
    idx = {}
    for r in ordered:  # pane indexes count firings per window: 0, 1, 2, ...
        idx.setdefault(r.window_start_ms, []).append(r.pane_index)
    assert all(v == list(range(len(v))) for v in idx.values())
    for r in ordered:
        label = f"{(r.window_start_ms // 60000) % 1440 // 60:02d}:{(r.window_start_ms // 60000) % 60:02d}"
        per_key.setdefault(label, []).append((r.dollar_turnover, r.dollar_timing))
    return per_key


@pytest.mark.parametrize("combine", [True, False])
def test_panes_g1(spark, tmp_dir, combine):
    g1 = [[("00:00:10", 1)], [("00:03:00", 3)], [("00:00:20", 2)], [("00:10:00", 10)],
          [("00:10:01", 1)], [("00:00:30", 5)]]
    assert _panes(spark, tmp_dir, g1, combine) == {
        "00:00": [(1, "EARLY"), (1, "ON_TIME"), (3, "LATE")],
        "00:03": [(3, "EARLY"), (3, "ON_TIME")],
        "00:10": [(10, "EARLY"), (11, "EARLY")],
    }


def test_panes_g2(spark, tmp_dir):
    g2 = [[("00:00:50", 1), ("00:00:51", 1.5)], [("00:05:40", 3)], [("00:05:41", 1)],
          [("00:00:30", 2)], [("00:07:00", 9)], [("00:07:01", 1)], [("00:00:40", 7)]]
    assert _panes(spark, tmp_dir, g2) == {
        "00:00": [(2.5, "EARLY"), (2.5, "ON_TIME"), (4.5, "LATE")],
        "00:05": [(3, "EARLY"), (4, "EARLY"), (4, "ON_TIME")],
        "00:07": [(9, "EARLY"), (10, "EARLY")],
    }


def _hm(ms):
    s = ms // 1000
    return f"{s // 3600 % 24:02d}:{s // 60 % 60:02d}" + (f":{s % 60:02d}" if s % 60 else "")


def test_sessions_g3(spark, tmp_dir):
    g3 = [[("00:00", "x", 1)], [("00:30", "x", 2), ("00:10", "y", 5)], [("00:20", "x", 9)],
          [("01:30", "x", 3)], [("02:00", "z", 1)], [("02:00:01", "z", 2)], [("00:45", "y", 6)],
          [("01:10", "y", 7)]]
    rows = [[{"ts": DAY + (t if t.count(":") == 2 else t + ":00"), "ride": k, "v": v, "seq": 100 * i + j}
             for j, (t, k, v) in enumerate(b)] for i, b in enumerate(g3)]
    got = _run(spark, tmp_dir, rows, "ts timestamp, ride string, v long, seq long",
               lambda s: session_updates(s, "ride", "ts", "seq", ["v"], ["long"], 60))
    per_key = {}
    for r in sorted(got.collect(), key=lambda r: (r.batch_id, RANK[r.timing], r.session_start_ms)):
        per_key.setdefault(r.ride, []).append((_hm(r.session_start_ms), _hm(r.session_end_ms), r.v, r.timing))
    assert per_key == {
        "x": [("00:00", "01:00", 1, "EARLY"), ("00:00", "01:30", 2, "EARLY"), ("00:00", "01:30", 2, "EARLY"),
              ("01:30", "02:30", 3, "EARLY"), ("00:00", "01:30", 2, "ON_TIME")],
        "y": [("00:10", "01:10", 5, "EARLY"), ("00:10", "01:10", 5, "ON_TIME"), ("01:10", "02:10", 7, "EARLY")],
        "z": [("02:00", "03:00", 1, "EARLY"), ("02:00", "03:00:01", 2, "EARLY")],
    }


def test_ride_jobs_end_to_end(spark, tmp_dir):
    msgs = []
    for i, (ride, t, inc, status) in enumerate([("r1", "00:00:10", 0.5, "enroute"), ("r1", "00:00:40", 0.25, "enroute"),
                                                 ("r2", "00:00:50", 1.0, "pickup"), ("r1", "00:01:20", 0.5, "dropoff")]):
        payload = {"ride_id": ride, "latitude": 40.5 + i, "longitude": -73.9, "timestamp": DAY + t + ".123456789-00:00",
                   "meter_reading": 10.0 + i, "meter_increment": inc, "ride_status": status, "passenger_count": 1}
        msgs.append([{"ts": DAY + t, "payload": json.dumps(payload)}])
    msgs.append([{"ts": DAY + "00:02:00", "payload": "{not json"}])
    # No ride id (no position), no meter value (no turnover), and two points of
    # one ride at the same millisecond: the first one seen stays.
    msgs.append([{"ts": DAY + "00:02:10", "payload": json.dumps({"latitude": 1.0, "longitude": 2.0,
                  "timestamp": DAY + "00:02:10Z", "meter_increment": 9.0, "ride_status": "x"})},
                 {"ts": DAY + "00:02:20", "payload": json.dumps({"ride_id": "r3", "latitude": 5.0, "longitude": 6.0,
                  "timestamp": DAY + "00:02:20Z", "ride_status": "first"})},
                 {"ts": DAY + "00:02:20", "payload": json.dumps({"ride_id": "r3", "latitude": 7.0, "longitude": 8.0,
                  "timestamp": DAY + "00:02:20Z", "ride_status": "second"})}])
    src = os.path.join(tmp_dir, "msgs")
    os.makedirs(src)
    for i, b in enumerate(msgs):
        p = os.path.join(src, f"m{i}.json")
        with open(p, "w") as f:
            f.write("\n".join(json.dumps(r) for r in b) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    from tidewater.streaming.sources import message_stream
    m = message_stream(spark, src, 1)
    q1 = jobs.start_turnover(m, f"{tmp_dir}/turnover", f"{tmp_dir}/ck1", {"availableNow": True}, early_seconds=0)
    q2 = jobs.start_positions(m, f"{tmp_dir}/pos", f"{tmp_dir}/table", f"{tmp_dir}/ck2", {"availableNow": True}, early_seconds=0)
    q1.awaitTermination()
    q2.awaitTermination()
    turnover = spark.read.json(f"{tmp_dir}/turnover")
    final = turnover.groupBy("dollar_window").agg(F.max("dollar_turnover").alias("t")).collect()
    assert sorted((r.dollar_window % 1440, r.t) for r in final) == [(0.0, 1.75), (1.0, 0.5), (2.0, 9.0)]
    log = sinks.read_table(spark, f"{tmp_dir}/pos")
    assert {"value", "ride_id", "session_start_ms", "timing", "batch_id", "day"} == set(log.columns)
    pos = log.select(F.from_json("value", "lat float, lon float, ride_id string, timestamp string, ride_status string").alias("p")).select("p.*")
    last = {r.ride_id: r for r in pos.collect() if r.ride_id == "r1" and r.timestamp.endswith("01:20.123Z")}
    assert last["r1"].ride_status == "dropoff"
    assert pos.where(F.col("ride_id").isNull()).count() == 0
    assert [r.ride_status for r in pos.where(F.col("ride_id") == "r3").collect()] == ["first"]
    table = sinks.read_table(spark, f"{tmp_dir}/table")
    import glob
    assert {os.path.basename(d).split("=")[0] for d in glob.glob(f"{tmp_dir}/table/*=*/*=*")} == {"day"}
    assert set(table.columns) >= {"ride_id", "latitude", "timestamp", "meter_reading", "day"}
    assert table.where(F.col("meter_reading").isNotNull()).count() == 0


def test_stream_sessions_chunked_equals_batch(spark, tmp_dir):
    from tidewater.operators import ordered
    from tidewater.session import conf_override
    sf = "/root/testdata/sf0.001"
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = ordered.sessionize(ev, "user_id", "ts", "event_id", 3_600_000, ["event_id"])
    want = sorted((r.user_id, r.n_events, r.latest.event_id) for r in batch.collect())
    from tidewater.streaming.sources import file_stream, table_files
    stream = file_stream(spark, table_files(sf, "events"),
                         "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                         "value double, props string").withColumn("ts", F.col("ts").cast("timestamp"))
    upd = session_updates(stream, "user_id", "ts", "event_id", ["event_id"], ["long"], 60)
    out = os.path.join(tmp_dir, "s")
    with conf_override(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": 3}):
        jobs.run_available(upd, out, os.path.join(tmp_dir, "ck"))
    final = jobs.latest_by_batch(spark, out, ["user_id", "session_start_ms"])
    got = sorted((r.user_id, r.n_events, r.event_id) for r in final.collect())
    assert got == want


def test_windowed_word_count_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "lines")
    os.makedirs(src)
    batches = [[("00:01:00", "hi there"), ("00:02:00", "hi")], [("00:12:00", "hi sue bob")],
               [("00:25:00", "bob hi")]]
    for i, b in enumerate(batches):
        p = os.path.join(src, f"b{i}.json")
        with open(p, "w") as f:
            f.write("\n".join(json.dumps({"ts": DAY + t, "value": v}) for t, v in b) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    lines = spark.readStream.schema("ts timestamp, value string").option("maxFilesPerTrigger", 1).json(src)
    q = jobs.start_windowed_word_count(lines, f"{tmp_dir}/out", f"{tmp_dir}/ck", 10, 0, 2,
                                       {"availableNow": True})
    q.awaitTermination()
    got = sinks.read_window_files(spark, f"{tmp_dir}/out")
    rows = sorted((r.window_label, r.value) for r in got.collect())
    # Windows 00:00 and 00:10 are closed by later data; 00:20 is still open.
    assert rows == [("00:00-00:10", "hi: 2"), ("00:00-00:10", "there: 1"),
                    ("00:10-00:20", "bob: 1"), ("00:10-00:20", "hi: 1"), ("00:10-00:20", "sue: 1")]


def _messages(spark, tmp, batches):
    """Batches of (ts, payload text) as a message stream, one batch per file and trigger."""
    src = os.path.join(tmp, "messages")
    os.makedirs(src)
    for i, b in enumerate(batches):
        p = os.path.join(src, f"m{i}.json")
        with open(p, "w") as f:
            f.write("\n".join(json.dumps({"ts": DAY + t, "payload": x}) for t, x in b) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    from tidewater.streaming.sources import message_stream
    return message_stream(spark, src, 1)


def _ride(ride, t, **more):
    return json.dumps({"ride_id": ride, "timestamp": None if t is None else t if t[0] == "x" else DAY + t + "Z",
                       "latitude": "1.5", "longitude": 2, "ride_status": "enroute", **more})


def test_latest_point_goes_by_payload_time(spark, tmp_dir):
    m = _messages(spark, tmp_dir, [[("00:00:10", _ride("a", "00:05:00"))], [("00:00:20", _ride("a", "00:01:00"))],
                                   [("00:00:20", _ride("b", "00:01:00", ride_status="one")),
                                    ("00:00:20", _ride("b", "00:01:00", ride_status="two"))]])
    jobs.finish(jobs.start_positions(m, f"{tmp_dir}/p", f"{tmp_dir}/t", f"{tmp_dir}/c", {"availableNow": True}, early_seconds=0))
    last = jobs.latest_rows(sinks.read_table(spark, f"{tmp_dir}/p").drop("day"), ["ride_id", "session_start_ms"])
    got = {r.ride_id: json.loads(r.value) for r in last.collect()}
    assert got["a"]["timestamp"].endswith("00:05:00.000Z") and got["b"]["ride_status"] == "one"


def test_bad_fields_go_to_rejects_and_do_not_end_the_stream(spark, tmp_dir):
    batch = [("00:00:01", _ride("a", "xyz", meter_increment="0.5")), ("00:00:02", _ride("a", None, meter_increment=1)),
             ("00:00:03", _ride(None, "00:00:03", meter_increment="n/a")), ("00:00:04", _ride("a", "00:00:04", passenger_count="1")),
             ("00:00:05", "[]"), ("00:00:06", None)]
    m = _messages(spark, tmp_dir, [batch])
    done = {"availableNow": True}
    jobs.finish(jobs.start_positions(m, f"{tmp_dir}/p", f"{tmp_dir}/t", f"{tmp_dir}/c1", done, early_seconds=0))
    jobs.finish(jobs.start_turnover(m, f"{tmp_dir}/o", f"{tmp_dir}/c2", done, early_seconds=0))
    jobs.finish(jobs.start_rejects(m, f"{tmp_dir}/r", f"{tmp_dir}/c3", done))
    assert sinks.read_table(spark, f"{tmp_dir}/p").count() == 1
    assert [r.dollar_turnover for r in spark.read.json(f"{tmp_dir}/o").where("dollar_timing = 'EARLY'").collect()] == [1.5]
    reasons = spark.read.json(f"{tmp_dir}/r").groupBy("branch", "reason").count().collect()
    assert {(r.branch, r.reason): r["count"] for r in reasons} == {
        ("turnover", "undecodable"): 2, ("positions", "undecodable"): 2, ("turnover", "bad_meter"): 1,
        ("turnover", "no_meter"): 1, ("positions", "no_ride_id"): 1, ("positions", "bad_time"): 2}


def test_a_moved_start_takes_back_the_old_one(spark, tmp_dir):
    rows = [[{"ts": DAY + "00:30:00", "k": "a", "id": 1}], [{"ts": DAY + "00:10:00", "k": "a", "id": 2}],
            [{"ts": DAY + "01:50:00", "k": "a", "id": 3}], [{"ts": DAY + "01:05:00", "k": "a", "id": 4}]]
    got = _run(spark, tmp_dir, rows, "ts timestamp, k string, id long",
               lambda s: session_updates(s, "k", "ts", "id", ["id"], ["long"], 60, out_of_order_minutes=60))
    last = jobs.latest_rows(got, ["k", "session_start_ms"])
    rows = {(_hm(r.session_start_ms), r.n_events, r.timing) for r in last.collect()}
    assert rows == {("00:10", 4, "EARLY"), ("00:30", 0, "RETRACTED"), ("01:50", 0, "RETRACTED")}


def test_replay_does_not_depend_on_the_number_of_files(spark, tmp_dir):
    from tidewater.plans import stream_queries as Q
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    results = []
    for n in (1, 4):
        d = f"{tmp_dir}/files{n}"
        ev.repartition(n).write.parquet(f"{d}/events.parquet")
        rows = Q.stream_panes(spark, d).collect()
        results.append(sorted((r.dollar_window, r.dollar_timing, r.dollar_turnover) for r in rows))
    assert results[0] == results[1]
    timings = [t for _, t, _ in results[0]]
    assert timings.count("LATE") > 0 and timings.count("ON_TIME") > 0


def _fast_batches(spark, tmp, build, schema, rows):
    """Batches through one running query, the next one as soon as the last is done."""
    src, out = f"{tmp}/fast", f"{tmp}/fast_out"
    for k, batch in enumerate(rows):
        os.makedirs(f"{src}/_b{k}")
        with open(f"{src}/_b{k}/r.json", "w") as f:
            f.write("".join(json.dumps(r) + "\n" for r in batch))
    q = None
    try:
        for k in range(len(rows)):
            os.rename(f"{src}/_b{k}", f"{src}/step-{k}")
            q = q or jobs.start_batches(build(spark.readStream.schema(schema).json(jobs.step_files(src))), out, f"{tmp}/fast_ck")
            q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(out).collect()


def test_two_batches_inside_one_delay_fire_one_early_pane(spark, tmp_dir):
    rows = [[{"ts": DAY + "00:00:10", "value": 1}], [{"ts": DAY + "00:00:20", "value": 2}], [{"ts": DAY + "00:20:00", "value": 4}]]
    got = _fast_batches(spark, tmp_dir, lambda s: pane_sums(s, early_seconds=3600), "ts timestamp, value double", rows)
    assert [(r.dollar_turnover, r.dollar_timing) for r in got] == [(3.0, "ON_TIME")]


def test_an_early_pane_comes_when_its_delay_is_over(spark, tmp_dir):
    """The second batch has data of another window only; it runs after the delay and fires what is due."""
    rows = [[{"ts": DAY + "00:00:10", "value": 1}], [{"ts": DAY + "00:01:20", "value": 2}], [{"ts": DAY + "00:02:20", "value": 2}]]
    got = _fast_batches(spark, tmp_dir, lambda s: pane_sums(s, early_seconds=0.001), "ts timestamp, value double", rows)
    first = [r for r in got if r.window_start_ms % 3_600_000 == 0]
    assert sorted((r.dollar_turnover, r.dollar_timing) for r in first) == [(1.0, "EARLY"), (1.0, "ON_TIME")]


def test_sessions_report_early_once_per_delay(spark, tmp_dir):
    rows = [[{"ts": DAY + "00:10:00", "k": "a", "id": 1}], [{"ts": DAY + "00:05:00", "k": "a", "id": 2}],
            [{"ts": DAY + "05:00:00", "k": "b", "id": 3}]]
    got = _fast_batches(spark, tmp_dir, lambda s: session_updates(s, "k", "ts", "id", ["id"], ["long"], 60, early_seconds=3600),
                            "ts timestamp, k string, id long", rows)
    assert [(r.k, r.n_events, r.timing) for r in got] == [("a", 2, "ON_TIME")]


@pytest.mark.parametrize("fails", ["second table", "commit", "nothing"])
def test_a_crash_between_or_inside_the_two_writes_loses_and_repeats_nothing(spark, tmp_dir, monkeypatch, fails):
    m = _messages(spark, tmp_dir, [[("00:00:10", _ride("a", "00:05:00"))], [("00:00:20", _ride("b", "00:01:00"))]])

    def run():
        return jobs.start_positions(m, f"{tmp_dir}/p", f"{tmp_dir}/t", f"{tmp_dir}/c", {"availableNow": True}, early_seconds=0)
    if fails == "second table":
        original = jobs.ride_table_rows
        monkeypatch.setattr(jobs, "ride_table_rows", lambda rows: original(rows).withColumn(
            "ride_status", F.when(F.raise_error(F.lit("lost")).isNull(), "x")))
    if fails == "commit":
        def lost(*a):
            raise RuntimeError("lost")
        monkeypatch.setattr(sinks, "move", lost)
    if fails != "nothing":
        with pytest.raises(Exception):
            jobs.finish(run())
        assert sinks.read_table(spark, f"{tmp_dir}/p").count() == sinks.read_table(spark, f"{tmp_dir}/t").count() == 0
        monkeypatch.undo()
    jobs.finish(run())
    jobs.finish(run())  # nothing new
    log = sinks.read_table(spark, f"{tmp_dir}/p").collect()
    table = sinks.read_table(spark, f"{tmp_dir}/t").collect()
    assert sorted((r.ride_id, r.timing) for r in log) == [("a", "EARLY"), ("b", "EARLY")]
    assert sorted(r.ride_id for r in table) == ["a", "b"]


def test_a_batch_that_was_committed_is_not_written_again(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "20240101")], "v int, day string")
    schema = rows.select("v").schema
    sinks.ensure_table(spark, f"{tmp_dir}/t", schema, ("day",), f"{tmp_dir}/log")
    assert sinks.read_table(spark, f"{tmp_dir}/t").count() == 0
    for stream, batch in (("q", 0), ("q", 0), ("q", 1), ("other", 0)):
        sinks.commit_batch(spark, f"{tmp_dir}/log", stream, batch, {f"{tmp_dir}/t": rows})
    assert sinks.read_table(spark, f"{tmp_dir}/t").count() == 3


def test_processors_travel_without_the_package(spark, tmp_dir):
    """The process that prepares them on the driver has no shipped files and may run in any folder."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from tidewater.streaming import state
    state._stateful(spark)
    made = [state.PaneSums(60_000, 0, 0), state.SessionUpdates(1000, ["v"], ["long"], 0, ["k", "v"])]
    with open(f"{tmp_dir}/made", "wb") as f:
        cloudpickle.dump(made, f)
    code = "import pickle, sys; print([type(x).__name__ for x in pickle.load(open('made', 'rb'))], 'tidewater' in sys.modules)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, capture_output=True, text=True, timeout=60,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.stdout.strip() == "['PaneSums', 'SessionUpdates'] False", done.stderr
