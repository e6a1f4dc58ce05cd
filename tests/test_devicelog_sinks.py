import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from tidewater import sinks, sources
from tidewater.operators import devicelog as D
from tidewater.operators import windows as Wn


def _device_doc():
    """Synthetic document of the device-log shape (no real identifiers)."""
    events = []
    t = 1_609_470_000_000
    for i, name in enumerate(["psRatChd", "batteryLevelRemaining", "psRatChd", "callStart", "psRatChd"]):
        e = {"name": name, "tStampMs": str(t + 1000 * i), "evId": str(i)}
        if name == "psRatChd":
            e.update({"prevPsRat": "UMTS", "psRat": "LTE"})
        events.append(e)
    events.append({"name": "ipStatus", "tStampMs": str(t + 9000), "evId": "9", "ipstatus": "up"})
    monitors = [{"type": "TPGV", "tStampMs": str(t), "evId": "20", "dlg": "17.250000"},
                {"type": "TPM", "tStampMs": str(t + 5), "evId": "21", "uniqTcId": "7", "tp": "12.5"}]
    ua = [{"uniqTcId": "7", "name": "TestFileTransfer", "evId": "30"},
          {"uniqTcId": "7", "result": "OK", "activeFor": "12", "tp": "1.5", "evId": "31"},
          {"uniqTcId": "8", "name": "Pause", "evId": "32"},
          {"uniqTcId": "8", "result": "OK", "evId": "33"},
          {"uniqTcId": "9", "result": "FAIL", "evId": "34"}]
    return {"info": {"formatVersion": "2"}, "events": events, "monitors": monitors, "useractions": ua,
            "testsuites": [{"device": "demo", "cpuFreq": [1, 2]}],
            "campaign": [{"exitCriteria": {"time": 60}, "scenarioDesc": [{"a": 1}]}]}


def test_sections_pairs_and_times(spark):
    doc = _device_doc()
    short = {"info": {"formatVersion": "2"}, "monitors": doc["monitors"]}
    parsed = D.parse_documents(sources.from_strings(spark, [json.dumps(doc), json.dumps(short), "{oops"]))
    good, bad = D.valid_documents(parsed), D.rejected_documents(parsed)
    assert good.count() == 1 and bad.count() == 2
    assert sorted(sorted(r._missing) for r in bad.collect()) == [
        ["campaign", "events", "info", "monitors", "testsuites", "useractions"],
        ["campaign", "events", "testsuites", "useractions"]]
    ev = D.section(good, "events")
    assert ev.count() == 6
    assert D.section(good, "info").first().row["formatVersion"] == "2"
    camp = D.section(good, "campaign").first().row
    assert json.loads(camp["exitCriteria"]) == {"time": 60}
    pairs = D.pair_actions(D.section(good, "useractions"))
    got = {r.uniqTcId: (r.type, r.result["result"] if r.result else None) for r in pairs.collect()}
    assert got == {"7": ("TestFileTransfer", "OK"), "8": ("Pause", "OK"), "9": (None, "FAIL")}
    assert D.unpaired(pairs).count() == 1
    sizes = {r.type: r.n for r in D.group_sizes(D.paired(pairs), "type").collect()}
    assert sizes == {"TestFileTransfer": 1, "Pause": 1}
    rows = D.event_rows(ev)
    rat = D.only_group(rows, "name", "psRatChd")
    t = 1_609_470_000_000
    done = D.complete_times(rat, bucket_ms=1000).orderBy("t_ms").collect()
    assert [(r.t_ms, r.tStampMsEnd) for r in done] == [
        (t, t + 2000), (t + 2000, t + 4000), (t + 4000, None)]
    transfers = D.only_group(D.paired(pairs), "type", "TestFileTransfer")
    att = D.attach_group(rat, transfers, [F.count(F.lit(1)).alias("n_actions")])
    assert [r.n_actions for r in att.collect()] == [1, 1, 1]


def test_wrong_typed_sections_are_rejected(spark):
    docs = []
    for name, bad in (("events", "oops"), ("useractions", None), ("info", [1]), ("monitors", {"a": 1}), ("campaign", [1, 2])):
        docs.append(json.dumps({**_device_doc(), name: bad}))
    parsed = D.parse_documents(sources.from_strings(spark, docs + [json.dumps(_device_doc())]))
    assert sorted(r._missing for r in D.rejected_documents(parsed).collect()) == [
        ["campaign"], ["events"], ["info"], ["monitors"], ["useractions"]]
    long = {r.section: r.n for r in D.group_sizes(D.sections_long(parsed), "section").collect()}
    assert long["_rejected"] == 5 and long["events"] == 6 and long["info"] == 1


def test_a_missing_table_is_created_with_its_schema(spark, tmp_dir):
    schema = T._parse_datatype_string("ride_id string, n bigint")
    sinks.ensure_table(spark, f"{tmp_dir}/t", schema, ("day",))
    sinks.ensure_table(spark, f"{tmp_dir}/t", schema, ("day",))
    empty = sinks.read_table(spark, f"{tmp_dir}/t")
    assert empty.columns == ["ride_id", "n", "day"] and empty.count() == 0
    with pytest.raises(sinks.SchemaMismatch):
        sinks.ensure_table(spark, f"{tmp_dir}/t", T._parse_datatype_string("ride_id string, n int"), ("day",))


def test_schema_guard(spark, tmp_dir):
    schema = T._parse_datatype_string("ride_id string, latitude double, timestamp timestamp")
    df = spark.createDataFrame([("r1", 1.0, None)], "ride_id string, latitude double, timestamp timestamp") \
              .withColumn("timestamp", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    path = f"{tmp_dir}/rides"
    sinks.append_day_partitioned(df, path, schema)
    sinks.append_day_partitioned(df, path, schema)
    back = spark.read.parquet(path)
    assert back.count() == 2 and [r.day for r in back.select("day").distinct().collect()] == [20240102]
    other = T._parse_datatype_string("ride_id string, latitude float, timestamp timestamp")
    with pytest.raises(sinks.SchemaMismatch):
        sinks.ensure_table_schema(spark, path, other, ("day",))


def test_window_files_and_partitions(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-01 23:55:00", "a: 1"), ("2024-01-02 00:01:00", "b: 2")],
                               "ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
    win = df.withColumn("window", F.window("ts", "10 minutes"))
    sinks.write_per_window(win, f"{tmp_dir}/w", num_shards=3)
    back = sinks.read_window_files(spark, f"{tmp_dir}/w")
    assert sorted((str(r.day), r.window_label, r.shards) for r in back.collect()) == [
        ("20240101", "23:50-00:00", 3), ("20240102", "00:00-00:10", 3)]
    import os
    names = sorted(f for _, _, fs in os.walk(f"{tmp_dir}/w") for f in fs if f.startswith("output"))
    assert len(names) == 2 and names[0].startswith("output-00%3A00-00%3A10-") and names[0].endswith("-of-3")
    sinks.write_per_window(win, f"{tmp_dir}/w")  # again, and with other shards: the windows' files are replaced
    assert sinks.read_window_files(spark, f"{tmp_dir}/w").select("shard", "shards").collect() == [(0, 1), (0, 1)]
    assert not [d for d in os.listdir(f"{tmp_dir}/w") if d.startswith("_")]
    with pytest.raises(ValueError):
        sinks.write_per_window(df, f"{tmp_dir}/x")
    parts = sinks.day_partition(win, "window").select("part").collect()
    assert sorted(r.part for r in parts) == ["20240101", "20240102"]
    iso = spark.createDataFrame([("2016-08-31T23:04:02.025396463-04:00", 20160101)], "t string, n int")
    assert sinks.day_partition(iso, "time", "t").first().part == "20160901"
    assert sinks.day_partition(iso, "number", "n").first().part == "20160101"


def test_ride_point_projection(spark):
    df = spark.createDataFrame([("r1", 40.123456789, -73.5, "2016-08-31T11:04:02.025396463-04:00", "enroute")],
                               "ride_id string, latitude double, longitude double, timestamp string, ride_status string")
    p = Wn.ride_point(df).first()
    assert p.ts_ms == 1472655842025 and abs(p.lat - 40.123456789) < 1e-5
    row = Wn.point_to_table_row(Wn.ride_point(df)).first()
    assert row.meter_reading is None and row.passenger_count is None
    msg = Wn.point_to_message(Wn.ride_point(df)).first()
    assert msg.timestamp == "2016-08-31T15:04:02.025Z"
    assert Wn.sum_without_default(df.where("false").withColumn("v", F.lit(1.0)), "v").count() == 0


def test_contract(spark):
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert E.entry(spark).count() > 0
    assert "stream_panes" in sql and "ride_positions" in sql


def test_hot_window_and_day_are_split_across_writers(spark, tmp_dir):
    """All rows in one window / one day: REBALANCE lets AQE split the hot
    directory over several tasks (several files), instead of one writer."""
    import glob
    from tidewater.session import conf_override
    df = spark.range(20000).select(
        F.lit("2024-01-01 00:01:00").cast("timestamp").alias("ts"),
        F.concat(F.lit("word: "), F.col("id").cast("string")).alias("value"))
    conf = {"spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    with conf_override(spark, conf):
        sinks.write_per_window(df.withColumn("window", F.window("ts", "10 minutes")), f"{tmp_dir}/w")
        schema = T._parse_datatype_string("value string, timestamp timestamp")
        sinks.append_day_partitioned(df.withColumnRenamed("ts", "timestamp"), f"{tmp_dir}/d", schema)
    wfiles = glob.glob(f"{tmp_dir}/w/day=20240101/output-*")
    dfiles = glob.glob(f"{tmp_dir}/d/day=20240101/*.parquet")
    assert len(wfiles) > 1 and len(dfiles) > 1
    assert spark.read.text(f"{tmp_dir}/w").count() == 20000
    assert spark.read.parquet(f"{tmp_dir}/d").count() == 20000
