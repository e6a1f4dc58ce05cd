"""The append-only message source: offsets, admission, restart, ranges, half lines."""

import io
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tidewater.streaming import message_log as M
from tidewater.streaming import sources as S


def _append(topic, shard, segment, data: bytes):
    os.makedirs(os.path.join(topic, shard), exist_ok=True)
    with open(os.path.join(topic, shard, segment), "ab") as f:
        f.write(data)


def _start(spark, tmp, most=0, split=64 << 20):
    log = S.log_stream(spark, f"{tmp}/topic", f"{tmp}/positions", most, split)
    return (log.writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ckpt")
               .trigger(processingTime="0 seconds").start())


def _run(spark, tmp, most=0, split=64 << 20):
    q = _start(spark, tmp, most, split)
    try:
        q.processAllAvailable()
        return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()


def _out(spark, tmp):
    rows = spark.read.schema(M.SCHEMA).parquet(f"{tmp}/out").collect()
    return sorted((r.shard, r.segment, r.position, bytes(r.value)) for r in rows)


def _expected(topic):
    out = []
    for folder, _, names in os.walk(topic):
        for name in names:
            shard = os.path.relpath(folder, topic).replace(".", "", 1) if folder == topic else os.path.relpath(folder, topic)
            with open(os.path.join(folder, name), "rb") as f:
                at = 0
                for line in f.read().splitlines(keepends=True):
                    out.append((shard, name, at, line.rstrip(b"\n")))
                    at += len(line)
    return sorted(out)


@given(st.lists(st.binary(max_size=6).map(lambda b: b.replace(b"\r", b"x")), max_size=12), st.integers(1, 9), st.booleans())
@settings(max_examples=200, deadline=None)
def test_ranges_share_the_lines(parts, split, ended):
    data = b"\n".join(parts) + (b"\n" if ended and parts else b"")
    want, at = [], 0
    for line in data.split(b"\n")[:-1] if data.endswith(b"\n") else data.split(b"\n") if data else []:
        want.append((at, line))
        at += len(line) + 1
    got = [x for a in range(0, len(data), split)
           for x in M.lines_from(io.BytesIO(data), a, min(a + split, len(data)), a == 0)]
    assert got == want


@pytest.mark.parametrize("block", [1, 3, 1 << 22])
def test_line_ends_are_found_whatever_the_block(monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    data = io.BytesIO(b"ab\n\ncde\nf")
    assert M.after_lines(data, 0, 9, 2) == (4, 2)
    assert M.after_lines(data, 0, 9, 9) == (8, 3)
    assert M.last_line_end(data, 0, 9) == 8 and M.last_line_end(data, 8, 9) == 8
    assert [line for _, line in M.lines_from(data, 0, 9, True)] == [b"ab", b"", b"cde", b"f"]


def test_batches_are_bounded_and_a_restart_goes_on(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    for shard in ("s0", "s1"):
        _append(topic, shard, "0001", b"".join(b"%s line %d\n" % (shard.encode(), i) for i in range(50)))
    sizes = _run(spark, tmp_dir, most=20)
    assert len(sizes) == 5 and max(sizes) <= 20
    # More messages, a new segment and a new shard while no query runs.
    _append(topic, "s0", "0001", b"late 1\nlate 2\n")
    _append(topic, "s0", "0002", b"next\n")
    _append(topic, "s2", "0001", b"new\n\n")
    assert sum(_run(spark, tmp_dir, most=20, split=7)) == 5
    assert _out(spark, tmp_dir) == _expected(topic)


def test_half_a_line_waits_and_an_ended_segment_gives_its_rest(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    _append(topic, "", "a", b"one\ntw")
    q = _start(spark, tmp_dir)
    try:
        q.processAllAvailable()
        assert [x[3] for x in _out(spark, tmp_dir)] == [b"one"]
        _append(topic, "", "a", b"o\nrest")
        q.processAllAvailable()
        assert [x[3] for x in _out(spark, tmp_dir)] == [b"one", b"two"]
        _append(topic, "", "b", b"three\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert [x[3] for x in _out(spark, tmp_dir)] == [b"one", b"two", b"rest", b"three"]


def test_an_end_given_out_but_not_taken_is_read_once(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    _append(topic, "", "a", b"".join(b"%d\n" % i for i in range(10)))
    _run(spark, tmp_dir, most=4)
    _append(topic, "", "a", b"".join(b"%d\n" % i for i in range(10, 20)))
    # A driver lost between writing the position and Spark's own log: the position is ahead.
    reader = M.MessageLogReader({"path": topic, "maxMessages": "4", "positions": f"{tmp_dir}/positions"})
    reader.latestOffset()
    sizes = _run(spark, tmp_dir, most=4)
    assert sum(sizes) == 10 and max(sizes) <= 8
    assert _out(spark, tmp_dir) == _expected(topic)


def test_a_lost_position_file_is_an_error_not_a_repeat(tmp_dir):
    _append(f"{tmp_dir}/topic", "", "a", b"1\n2\n3\n")
    reader = M.MessageLogReader({"path": f"{tmp_dir}/topic", "maxMessages": "1", "positions": f"{tmp_dir}/p"})
    with pytest.raises(ValueError, match="goes back"):
        reader.partitions({"": ["a", 6]}, reader.latestOffset())
    with pytest.raises(ValueError, match="maxMessages"):
        M.MessageLogReader({"path": tmp_dir, "maxMessages": "1"})


def test_attributes_stand_apart_from_the_payload(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    good = {"ts": "2024-01-01T00:00:00Z", "payload": '{"a": 1}', "attributes": {"from": "x"}}
    _append(topic, "", "a", json.dumps(good).encode() + b"\nno object\n")
    log = S.log_messages(S.log_stream(spark, topic))
    q = log.writeStream.format("memory").queryName("log_attributes").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    a, b = spark.table("log_attributes").orderBy("position").select(
        F.unix_seconds("ts"), F.col("payload").cast("string"), "attributes", "position").collect()
    assert tuple(a) == (1704067200, '{"a": 1}', {"from": "x"}, 0)
    assert b[:3] == (None, None, None) and b[3] > 0


def test_an_empty_topic_gives_no_rows(spark, tmp_dir):
    assert _run(spark, tmp_dir) == [] and _out(spark, tmp_dir) == []
